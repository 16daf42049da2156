"""Set-difference checks: gaps (J6/I1), coverage (M10/U4), column contract (W14), data
constraints (W15)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingDatesError(ValueError):
    pass


def missing_values(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that are not present (``left_anti``)."""
    return expected.select(*keys).distinct().join(present.select(*keys).distinct(), list(keys), "left_anti")


def coverage_gaps(requested: DataFrame, loaded: DataFrame | None, found: DataFrame, col: str) -> DataFrame:
    """Dates that must have rows (requested ∩ loaded partitions) but have none in ``found``.

    Requested dates without a loaded partition are skipped, as upstream.
    """
    enforce = requested.select(col).distinct()
    if loaded is not None:
        enforce = enforce.join(loaded.select(col).distinct(), col, "left_semi")
    return enforce.join(found.select(col).distinct(), col, "left_anti")


def raise_if_gaps(gaps: DataFrame, col: str, what: str) -> None:
    """M10 guard: ValueError with the number of missing dates and the first 50 of them."""
    first = [str(r[0]) for r in gaps.orderBy(col).limit(50).collect()]
    if first:
        raise MissingDatesError(f"{what} has no rows for {gaps.count()} requested dates, the first being {first}")


class ConstraintError(ValueError):
    pass


def check_columns(table: str, columns: Sequence[str], expected: Sequence[str]) -> None:
    """The column set has to be the table's own; both differences are named at once (no data is read)."""
    lacking, foreign = sorted(set(expected) - set(columns)), sorted(set(columns) - set(expected))
    if lacking or foreign:
        raise ValueError(f"{table} takes {len(expected)} columns: lacking {lacking or 'none'}, unknown {foreign or 'none'}")


def constraint_violations(df: DataFrame, table: str, key: Sequence[str], not_null: Sequence[str] = (),
                          allowed: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One row per check (table, check, n_violations) — PK uniqueness, NOT NULL, IN (...).

    One pass for the row checks (a single aggregate), one aggregate for key duplicates.
    """
    allowed = allowed or {}
    exprs = []
    names = []
    for c in not_null:
        names.append(f"not_null:{c}")
        exprs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"v{len(exprs)}"))
    for c, vals in allowed.items():
        names.append(f"in:{c}")
        exprs.append(F.sum((F.col(c).isNotNull() & ~F.col(c).isin(*vals)).cast("long")).alias(f"v{len(exprs)}"))
    for c in key:
        names.append(f"pk_not_null:{c}")
        exprs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"v{len(exprs)}"))
    row_checks = df.agg(*exprs) if exprs else None
    dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_violations"))
           .select(F.lit(table).alias("table_name"), F.lit("pk_unique").alias("check_name"), "n_violations"))
    if row_checks is None:
        return dup
    stack = ", ".join(f"'{n}', coalesce(v{i}, 0L)" for i, n in enumerate(names))
    rows = row_checks.selectExpr(f"stack({len(names)}, {stack}) as (check_name, n_violations)") \
        .select(F.lit(table).alias("table_name"), "check_name", F.col("n_violations").cast("long"))
    return rows.unionByName(dup)
