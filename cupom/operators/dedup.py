"""Deterministic keep-first / keep-last (D1–D7) and distinct-sort.

"First" and "last" need an explicit order: Spark has no row order. Callers pass the order
columns; :func:`with_file_order` derives the landed-file order (partition value, file, row).

One ``row_number`` per key with a filter on 1: Spark turns it into a group limit that each map task applies before
the shuffle (``WindowGroupLimit … Partial`` in the plan), so a hot key sends one row per task and is never sorted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEQ = "_seq"


def with_file_order(df: DataFrame, partition_col: str | None = None, name: str = SEQ) -> DataFrame:
    """Add ``name`` = struct(partition value, file path, row index) for Parquet-backed frames."""
    parts = []
    if partition_col is not None:
        parts.append(F.col(partition_col).cast("string").alias("p"))
    parts += [F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")]
    return df.withColumn(name, F.struct(*parts))


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    if not order:
        raise ValueError("keep-first/last needs an explicit order (Spark rows have none)")
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() if last else c.asc_nulls_first() for c in columns])
    return df.withColumn("_keep", F.row_number().over(w)).where("_keep = 1").drop("_keep")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest ``order``."""
    return _keep(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the largest ``order``."""
    return _keep(df, keys, order, last=True)


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values ordered ascending (holidays)."""
    return df.select(*cols).distinct().orderBy(*cols)
