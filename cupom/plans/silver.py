"""Silver transforms (T1–T10): bronze rows → canonical typed rows.

Upstream runs each transform one partition at a time; here each runs once over every pending
partition: the per-partition date filter (F1) becomes ``date == partition value`` on the column
carried by the bronze reader (``partition_col``), or a semi-join on an explicit date list.
Rename maps and column lists are the public data model (fixed values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.functions.coerce import (month_to_date, to_date_any, to_double, to_long, trim_text,
                                    yyyymm_to_date)
from cupom.operators.dedup import keep_first, keep_last
from cupom.operators.reshape import (dedupe_column_names, pivot_long, project_columns, raise_on_duplicate_keys,
                                     rename_aliases)
from cupom.sources.landing import VAR_IPCA_INDEX, VAR_IPCA_MOM, inflation_long

# Rename maps of the landed feeds.
MERCADO_SECUNDARIO_RENAME = {"taxa_indicativa": "taxa_anbima"}
MERCADO_SECUNDARIO_NUMERIC = ("taxa_anbima", "intervalo_min_d0", "intervalo_max_d0", "intervalo_min_d1",
                              "intervalo_max_d1", "pu")
LIQUIDACOES_RENAME = {"DATA MOV": "data_referencia", "NUM DE OPER": "qtd_operacoes",
                      "QUANT NEGOCIADA": "qtd_titulos", "PU MED": "pu_medio", "SIGLA": "tipo_titulo",
                      "VENCIMENTO": "data_vencimento"}
LIQUIDACOES_NUMERIC = ("qtd_operacoes", "qtd_titulos", "pu_medio")
AJUSTES_BMF_RENAME = {"RptDt": "data_referencia", "TckrSymb": "ticker", "ISIN": "codigo_isin",
                      "XprtnDt": "data_vencimento", "AdjstdQtTax": "taxa_ajuste", "AdjstdQt": "quantidade_ajuste"}
AJUSTES_BMF_NUMERIC = ("taxa_ajuste", "quantidade_ajuste")
BMF_PREFIXES = ("DAP", "DI1")
LEILOES_RENAME = {"data_leilao": "data_referencia", "titulo": "tipo_titulo", "vencimento": "data_vencimento"}
LEILOES_NUMERIC = ("numero_edital", "oferta", "quantidade_aceita", "percentual_corte", "oferta_segunda_volta",
                   "financeiro_aceito", "financeiro_aceito_segunda_volta", "quantidade_aceita_segunda_volta",
                   "pu_medio", "taxa_media")
PTAX_RENAME = {"data": "data_referencia", "taxa_compra": "ptax_compra", "taxa_venda": "ptax_venda"}
VNA_RENAME = {"data": "data_referencia", "Data": "data_referencia", "dt_referencia": "data_referencia",
              "codigoSelic": "codigo_selic", "codigo": "codigo_selic", "cod_selic": "codigo_selic",
              "tipoCorrecao": "tipo_correcao", "correcao": "tipo_correcao", "indice": "index", "índice": "index",
              "dataValidade": "data_validade", "validade": "data_validade", "VNA": "vna", "valor_vna": "vna",
              "valor": "vna"}
VNA_DATE_ALIASES = ("data_referencia", "data", "Data", "dt_referencia")
VNA_TITLES_ALIASES = ("titulos", "Titulos", "itens")

CDI_COLUMNS = ("data_referencia", "cdi")
PTAX_COLUMNS = ("data_referencia", "tipo", "moeda", "ptax_compra", "ptax_venda")
PROJECOES_COLUMNS = ("indice", "tipo_projecao", "data_coleta", "ref_month", "variacao_projetada", "data_validade")
VNA_COLUMNS = ("data_referencia", "codigo_selic", "tipo_correcao", "index", "data_validade", "vna")
IPCA_COLUMNS = ("ref_month", "ipca_index", "ipca_mom")

_D, _F, _L, _S = T.DateType(), T.DoubleType(), T.LongType(), T.StringType()


def _coerce(df: DataFrame, numeric: Sequence[str] = (), dates: Sequence[str] = (), comma: bool = False) -> DataFrame:
    repl = {c: to_double(F.col(f"`{c}`"), comma_decimal=comma) for c in numeric if c in df.columns}
    repl.update({c: to_date_any(F.col(f"`{c}`")) for c in dates if c in df.columns})
    return df.withColumns(repl) if repl else df


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return rename_aliases(df, present) if present else df


def keep_partition_dates(df: DataFrame, date_col: str, partition_col: str | None,
                         dates: DataFrame | None = None) -> DataFrame:
    """rows of their partition's date (or of an explicit date list)."""
    if dates is not None:
        return df.join(dates.select(F.col(dates.columns[0]).cast("date").alias(date_col)), date_col, "left_semi")
    if partition_col is not None and partition_col in df.columns:
        return df.where(F.col(date_col) == F.col(partition_col).cast("date"))
    return df


def _carry(df: DataFrame, extra: Sequence[str]) -> list[str]:
    return [c for c in extra if c in df.columns]


def cdi(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None,
        carry: Sequence[str] = ("_seq",)) -> DataFrame:
    """estimativa_taxa_selic → cdi (double), date coerced, two columns, F1."""
    x = _coerce(_rename(df, {"estimativa_taxa_selic": "cdi"}), ["cdi"], ["data_referencia"])
    x = project_columns(x, list(CDI_COLUMNS) + _carry(df, [partition_col] if partition_col else []) +
                        _carry(df, carry), {"data_referencia": _D, "cdi": _F})
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def ptax(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None,
         carry: Sequence[str] = ("_seq",)) -> DataFrame:
    """Tipo 'A' (trimmed) and moeda USD (trimmed, upper); parities and code dropped; renamed."""
    x = df
    if "tipo" in x.columns:
        x = x.where(F.trim(F.col("tipo").cast("string")) == "A")
    if "moeda" in x.columns:
        x = x.where(F.upper(F.trim(F.col("moeda").cast("string"))) == "USD")
    x = x.drop(*[c for c in ("paridade_compra", "paridade_venda", "codigo") if c in x.columns])
    x = _coerce(_rename(x, PTAX_RENAME), ["ptax_compra", "ptax_venda"], ["data_referencia"])
    x = project_columns(x, list(PTAX_COLUMNS) + _carry(df, [partition_col] if partition_col else []) +
                        _carry(df, carry), {"data_referencia": _D, "ptax_compra": _F, "ptax_venda": _F})
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def mercado_secundario(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """taxa_indicativa → taxa_anbima, six numeric coercions, two date coercions; extra columns kept."""
    x = _coerce(_rename(df, MERCADO_SECUNDARIO_RENAME), MERCADO_SECUNDARIO_NUMERIC,
                ["data_referencia", "data_vencimento"])
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def liquidacoes_mercado(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """T4: upper-case headers renamed, comma decimals, dates coerced."""
    x = _coerce(_rename(df, LIQUIDACOES_RENAME), LIQUIDACOES_NUMERIC, ["data_referencia", "data_vencimento"],
                comma=True)
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def ajustes_bmf(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """T5: DI1/DAP tickers only (F2; a NULL ticker is dropped), duplicate column names removed,
    RptDt dropped when data_referencia exists, renamed, comma decimals, dates coerced."""
    x = dedupe_column_names(df)
    if "TckrSymb" in x.columns:
        t = F.col("TckrSymb").cast("string")
        x = x.where(F.coalesce(t.startswith(BMF_PREFIXES[0]) | t.startswith(BMF_PREFIXES[1]), F.lit(False)))
    if "data_referencia" in x.columns and "RptDt" in x.columns:
        x = x.drop("RptDt")
    x = _coerce(_rename(x, AJUSTES_BMF_RENAME), AJUSTES_BMF_NUMERIC, ["data_referencia", "data_vencimento"],
                comma=True)
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def leiloes(df: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Renamed, dates coerced, ISO-shape check on both dates (F4), ten numeric coercions."""
    x = _coerce(_rename(df, LEILOES_RENAME), (), ["data_referencia", "data_vencimento"])
    for c in ("data_referencia", "data_vencimento"):
        if c in x.columns:
            x = x.where(F.date_format(c, "yyyy-MM-dd").rlike(r"^(\d{4}|\+\d{5,7})-\d{2}-\d{2}$"))
    x = _coerce(x, LEILOES_NUMERIC)
    if "numero_edital" in x.columns:
        x = x.withColumn("numero_edital", F.col("numero_edital").cast("bigint"))
    if "oferta" in x.columns:
        x = x.withColumn("oferta", F.col("oferta").cast("bigint"))
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def ipca_indice(df: DataFrame, partition_col: str | None = None, check_duplicates: bool = True) -> DataFrame:
    """Any of the inflation layouts → long → month (C6) → duplicate-key check (G1) → pivot
    (G2) → the partition's month only."""
    long = inflation_long(df, [c for c in ("_file", partition_col) if c and c in df.columns])
    long = long.withColumn("ref_month", yyyymm_to_date(F.col("DATA_CODIGO")))
    bad = long.where(F.col("ref_month").isNull()).select("DATA_CODIGO").limit(1).collect()
    if bad:
        raise ValueError(f"inflation table: invalid DATA_CODIGO (expected YYYYMM): {bad[0][0]!r}")
    keys = ["ref_month", "VAR_CODIGO"] + ([partition_col] if partition_col and partition_col in long.columns else [])
    if check_duplicates:
        raise_on_duplicate_keys(long, keys, "inflation table")
    row_key = "ref_month"
    if partition_col and partition_col in long.columns:
        long = long.where(F.col("ref_month") == F.col(partition_col).cast("date"))
    piv = pivot_long(long, row_key, "VAR_CODIGO", "VALOR", {VAR_IPCA_INDEX: "ipca_index", VAR_IPCA_MOM: "ipca_mom"})
    return piv.select(F.col("ref_month"), F.col("ipca_index").cast("double"), F.col("ipca_mom").cast("double"))


def projecoes(df: DataFrame, carry: Sequence[str] = ("_seq",)) -> DataFrame:
    """mes_referencia → ref_month (C4), dates (C2), dot decimals (C1), trimmed text (C11);
    every revision is kept (no dedup)."""
    x = _rename(df, {"mes_referencia": "ref_month"})
    x = _coerce(x, ["variacao_projetada"], ["data_coleta", "data_validade"])
    x = x.withColumns({c: trim_text(F.col(c)) for c in ("indice", "tipo_projecao") if c in x.columns})
    if "ref_month" in x.columns:
        x = x.withColumn("ref_month", month_to_date(F.col("ref_month")))
    return project_columns(x, list(PROJECOES_COLUMNS) + _carry(df, carry),
                           {"data_coleta": _D, "ref_month": _D, "variacao_projetada": _F, "data_validade": _D})


def feriados(df: DataFrame, col: str = "Data") -> DataFrame:
    """``Data`` → ``data`` dates, nulls dropped, distinct, sorted."""
    c = col if col in df.columns else "data"
    return df.select(to_date_any(F.col(c)).alias("data")).where(F.col("data").isNotNull()).distinct().orderBy("data")


# Alias keys of the VNA title fields, in lookup order.
VNA_FIELD_ALIASES = {
    "codigo_selic": ("codigo_selic", "codigoSelic", "codigo", "cod_selic"),
    "tipo_correcao": ("tipo_correcao", "tipoCorrecao", "correcao"),
    "index": ("index", "indice", "índice"),
    "data_validade": ("data_validade", "dataValidade", "validade"),
    "vna": ("vna", "VNA", "valor_vna", "valor"),
    "data_referencia": ("data_referencia", "data", "Data", "dt_referencia"),
}
#: A title's fields under every alias, exact in case (``vna`` and ``VNA`` are two).
_TITLE = T.StructType([T.StructField(k, T.StringType()) for keys in VNA_FIELD_ALIASES.values() for k in keys])


def _pick(m: str, keys) -> "F.Column":
    return F.coalesce(*[F.col(m).getItem(k) for k in keys])


def vna_records(payload: DataFrame, record_col: str = "rec", order: Sequence[str] = ("_seq",)) -> DataFrame:
    """N1 for VNA payloads: day records → one row per title, the day's date pushed down when the
    title lacks one (P9 alias lookup per field). Day records are ``map<string,string>``: JSON keys that
    differ only in case stay distinct. Titles are parsed once, by the generator (an outer one, so that no
    filter that Spark infers parses them again), into records whose fields are taken by position.

    A day record without a title list but with a selic code is itself a title row.
    """
    m = F.col(record_col)
    titles_text = F.coalesce(*[m.getItem(k) for k in VNA_TITLES_ALIASES])
    own = F.struct(*[m.getItem(f.name).alias(f.name) for f in _TITLE])
    is_title = titles_text.isNull() & _pick(record_col, VNA_FIELD_ALIASES["codigo_selic"]).isNotNull()
    # Taken out of the record first: what stands beside a generator is worked out behind it, and each title would carry the record.
    x = payload.select(*order, _pick(record_col, VNA_DATE_ALIASES).alias("_day"), titles_text.alias("_titles"), F.when(is_title, F.array(own)).alias("_self"))
    titles = F.coalesce(F.from_json("_titles", T.ArrayType(_TITLE)), F.col("_self"))
    x = x.select(*order, "_day", F.posexplode_outer(titles).alias("_pos", "_t"))
    x = x.where(F.col("_t").isNotNull()).select(*order, "_day", "_pos", "_t.*")
    x = x.toDF(*order, "_day", "_pos", *[f"_f{i}" for i in range(len(_TITLE))])
    places, fields = iter(range(len(_TITLE))), {}
    for name, keys in VNA_FIELD_ALIASES.items():
        fields[name] = F.coalesce(*[F.col(f"_f{next(places)}") for _ in keys])
    day = F.coalesce(fields.pop("data_referencia"), F.col("_day"))
    return x.select(*order, "_pos", day.alias("data_referencia"), *[c.alias(n) for n, c in fields.items()])


def vna(rows: DataFrame, partition_col: str | None = None, dates: DataFrame | None = None,
        order: Sequence[str] = ("_seq", "_pos")) -> DataFrame:
    """T10 (after :func:`vna_records`): aliases, dates, comma decimals, nullable selic code,
    trimmed correction type, rows without date / code / value dropped (F5), last per
    (date, code) in landed order (D5), fixed columns, F1."""
    x = _rename(rows, VNA_RENAME)
    x = _coerce(x, ["index", "vna"], ["data_referencia", "data_validade"], comma=True)
    if "codigo_selic" in x.columns:
        x = x.withColumn("codigo_selic", to_long(F.col("codigo_selic")))
    if "tipo_correcao" in x.columns:
        x = x.withColumn("tipo_correcao", trim_text(F.col("tipo_correcao")))
    for c in ("data_referencia", "codigo_selic", "vna"):
        if c in x.columns:
            x = x.where(F.col(c).isNotNull())
    keep_order = [c for c in order if c in x.columns]
    extra = [partition_col] if partition_col and partition_col in x.columns else []
    x = project_columns(x, list(VNA_COLUMNS) + extra + keep_order,
                        {"data_referencia": _D, "codigo_selic": _L, "index": _F, "data_validade": _D, "vna": _F})
    x = keep_last(x, ["data_referencia", "codigo_selic"], keep_order).drop(*keep_order)
    return keep_partition_dates(x, "data_referencia", partition_col, dates)


def ipca_rows_with_order(monthly: DataFrame, partition_col: str | None = None) -> DataFrame:
    """Monthly index rows with a landed-order column for the as-of builder (month, then file)."""
    seq = [F.col("ref_month")] + ([F.col(partition_col)] if partition_col and partition_col in monthly.columns else [])
    return monthly.withColumn("_seq", F.struct(*seq))


__all__ = ["cdi", "ptax", "mercado_secundario", "liquidacoes_mercado", "ajustes_bmf", "leiloes", "ipca_indice",
           "projecoes", "feriados", "vna_records", "vna", "keep_first", "keep_partition_dates"]
