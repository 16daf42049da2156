"""Helpers shared by the training-data operators: table access, shared folders, Arrow text as numpy."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from cupom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes that Spark hands a Python worker at a time: texts are long, and workers share an executor's memory.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that they need no copy of the repository, and bound what they get at once."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(sc, "_cupom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="cupom-ship-"), "cupom_workers.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._cupom_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs start from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OWNER: list = [None, None]


def claim(name: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called as a task begins: make ``name`` the operator that a reused Python worker serves, and give back what it doesn't need.

    Workers outlive their tasks; another operator's caches (vocabularies, transducer states, benchmark blocks) are cleared, and
    pages that the last task freed go back to the system, where the C library can.
    """
    if _OWNER[0] != name:
        if _OWNER[1] is not None:
            _OWNER[1]()
            gc.collect()
        _OWNER[:] = [name, clear]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the rows' n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8, last - first, first) if last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def texts(column: pa.Array) -> list[str]:
    """Rows as str; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]
