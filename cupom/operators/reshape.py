"""Reshaping operators: pivot (G2), duplicate-key check (G1), month→business-day expansion (J1),
payload flattening (S14), column-set helpers (P2, P3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.functions.coerce import to_date_any, to_double, to_long


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """G1: keys that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def raise_on_duplicate_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """G1 guard: ValueError with the number of duplicated keys and ten of them."""
    found = duplicate_keys(df, keys)
    sample = found.limit(10).collect()
    if sample:
        raise DuplicateKeyError(f"{what}: {found.count()} duplicated keys, among them {[tuple(r) for r in sample]}")


def pivot_long(df: DataFrame, row_key: str, var_col: str, value_col: str,
               mapping: Mapping[str, str]) -> DataFrame:
    """Long (row_key, variable, value) → one row per key and one column per mapped variable.

    The variable list is fixed (no value scan); a variable absent from the data gives a NULL column.
    Keys must be unique per (row_key, variable) — check with :func:`raise_on_duplicate_keys`.
    """
    wanted = list(mapping)
    p = (df.where(F.col(var_col).isin(wanted))
         .groupBy(row_key).pivot(var_col, wanted).agg(F.first(value_col)))
    return p.select(row_key, *[F.col(f"`{v}`").alias(name) for v, name in mapping.items()])


def monthly_as_daily(days: DataFrame, day_col: str, monthly: DataFrame, month_col: str) -> DataFrame:
    """Every day joined to its month's rows (left join; days without a month keep NULLs).

    ``monthly`` is one row per month in practice (it grows with months, not with data volume); the
    join is left to AQE, which broadcasts it after measuring it.
    """
    d = days.withColumn("reference_month", F.trunc(F.col(day_col), "MM"))
    m = monthly.withColumn("reference_month", F.trunc(F.col(month_col).cast("date"), "MM"))
    if month_col != "reference_month":
        m = m.drop(month_col) if month_col in m.columns else m
    metric = [c for c in m.columns if c not in ("reference_month", day_col)]
    return d.join(m, "reference_month", "left").select(day_col, "reference_month", *metric)


def flatten_payload(text: Column, record: T.StructType) -> Column:
    """A JSON payload that is an object, a list, or a list of lists → array of records."""
    as_list = F.from_json(text, T.ArrayType(record))
    as_nested = F.flatten(F.from_json(text, T.ArrayType(T.ArrayType(record))))
    as_one = F.array(F.from_json(text, record))
    trimmed = F.ltrim(text)
    return (F.when(trimmed.startswith("[["), as_nested)
            .when(trimmed.startswith("["), as_list)
            .when(trimmed.startswith("{"), as_one))


def dedupe_column_names(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with the same name."""
    seen: set[str] = set()
    idx = []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            idx.append(i)
    if len(idx) == len(df.columns):
        return df
    tmp = [f"_c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*tmp)
    return renamed.select(*[F.col(tmp[i]).alias(df.columns[i]) for i in idx])


def coerced(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A column in its declared type; text goes through the coercion rules."""
    if isinstance(given, T.StringType):
        rule = {"double": to_double, "date": to_date_any, "long": to_long, "integer": to_long}.get(wanted.typeName())
        if rule is not None:
            return rule(value).try_cast(wanted)
    return value.try_cast(wanted)


def project_columns(df: DataFrame, columns: Sequence[str], types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Fixed column list; declared types are applied (text by the coercion rules: what is no number
    or date becomes NULL, never an error), missing columns are added as NULL."""
    types = types or {}
    out = []
    for c in columns:
        if c in df.columns:
            out.append(coerced(F.col(f"`{c}`"), df.schema[c].dataType, types[c]).alias(c) if c in types else F.col(f"`{c}`"))
        else:
            out.append(F.lit(None).cast(types.get(c, T.StringType())).alias(c))
    return df.select(*out)


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename by an alias map; several aliases of one target are coalesced in map order."""
    targets: dict[str, list[str]] = {}
    for src, dst in aliases.items():
        if src in df.columns:
            targets.setdefault(dst, []).append(src)
    if not targets:
        return df
    sources = {s for ss in targets.values() for s in ss}
    out = []
    placed: set[str] = set()
    for c in df.columns:
        if c in sources:
            dst = next(d for d, ss in targets.items() if c in ss)
            if dst in placed:
                continue
            srcs = targets[dst] + ([dst] if dst in df.columns and dst not in targets[dst] else [])
            out.append((F.coalesce(*[F.col(f"`{s}`") for s in srcs]) if len(srcs) > 1
                        else F.col(f"`{srcs[0]}`")).alias(dst))
            placed.add(dst)
        elif c in targets and c not in placed:
            continue  # folded into the coalesce above
        elif c not in placed:
            out.append(F.col(f"`{c}`"))
    for dst, srcs in targets.items():
        if dst not in placed:
            out.append(F.col(f"`{srcs[0]}`").alias(dst))
    return df.select(*out)
