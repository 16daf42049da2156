"""Column registry: the columns that a dataset has had in a layer so far, with their types, in the order of their first run.

Every write adds the columns that are new, before the data; every read uses the registry as its schema. So a read neither samples
footers nor merges them, and a column that came later is there (NULL in older partitions). The registry is a folder of small files
``{root}/schemas/{layer}/{dataset}/``, one for each run that brought columns, which the driver reads.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from cupom.sources import files


class ColumnTypeError(ValueError):
    pass


def _folder(root: str, layer: str, dataset: str) -> str:
    return f"{root}/schemas/{layer}/{dataset}"


def columns(spark: SparkSession, root: str, layer: str, dataset: str) -> T.StructType | None:
    """Columns of a dataset in a layer; None before its first write."""
    out: dict[str, T.StructField] = {}
    for path in files.list_files(spark, _folder(root, layer, dataset)):
        for f in T.StructType.fromJson(json.loads(files.read_text(spark, path))):
            out.setdefault(f.name.lower(), f)
    return T.StructType(list(out.values())) if out else None


def register(spark: SparkSession, root: str, layer: str, dataset: str, schema: T.StructType) -> None:
    """Add the columns that are new; a known column with another type is an error, before anything is written."""
    known = {f.name.lower(): f for f in columns(spark, root, layer, dataset) or []}
    new = []
    for f in schema:
        old = known.get(f.name.lower())
        if old is None:
            new.append(T.StructField(f.name, f.dataType, True))
        elif old.dataType.simpleString() != f.dataType.simpleString():
            raise ColumnTypeError(f"{layer}/{dataset}: column {f.name!r} was {old.dataType.simpleString()} in earlier runs and is {f.dataType.simpleString()} now")
    if new:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        files.write_text(spark, f"{_folder(root, layer, dataset)}/{name}", T.StructType(new).json())
