"""The library's operators run over the driver's test tables (``/root/testdata/sf*/``).

The upstream feeds do not exist there, so each entry renders a feed-shaped input from a test
table with DataFrame expressions (whole tables, every row) and then runs the library operator.
Each entry has an independently written DuckDB statement that computes the same result
directly from the same tables; the driver compares both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cupom.functions import calendar as cal
from cupom.functions.coerce import month_partition_key, month_to_date, to_date_any, to_double, yyyymm_to_date
from cupom.operators.checks import constraint_violations, coverage_gaps
from cupom.operators.dedup import keep_first, keep_last
from cupom.operators.reshape import duplicate_keys, monthly_as_daily, pivot_long
from cupom.operators.textnum import column_comma_decimal, disambiguate_slash_dates
from cupom.plans import silver
from cupom.plans.gold import materialize
from cupom.plans.incremental import gap_rows, stale_partitions
from cupom.plans.ipca import PROJ_TIPO, build_ipca_daily
from cupom.plans.reader import DateSeries, QuotesSettlements
from cupom.plans.refresh import delete_dates, refresh_scope
from cupom.sinks.lake import merge_revisions
from cupom.sinks.tables import bond_dimension_batch, merge_by_key
from cupom.sources.landing import combine_ptax, newest_file_rows, parse_ptax_lines
from cupom.sources import landing as landing_mod

# Fixed query parameters.
ON_DATE = "1998-06-15"
RANGE = ("1998-01-01", "1998-03-31")
LATEST_N = 5
LATEST_N_COMBINED = 10
PTAX_WINDOW = ("2024-01-03", "2024-01-28")
REFRESH_WINDOW = ("1998-01-01", "1999-12-31")
UPSERT_BASE_BEFORE = "1999-01-01"
UPSERT_BATCH_FROM = "1998-07-01"
REVISIONS_EXISTING_BEFORE = "2024-01-20"
REVISIONS_NEW_FROM = "2024-01-15"
HOLIDAY = "dayofyear({d}) % 29 = 3"  # days that stand for holidays where they are weekdays: a rule on the date, at any scale
NEXT_TIPO = "PROJEÇÕES PARA O MÊS SEGUINTE"

LINEITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _d(c: str) -> Column:
    return F.col(c).cast("date")


def _li_seq() -> Column:
    return F.struct(*[F.col(c) for c in LINEITEM_ORDER])


# ------------------------------------------------------------------------- date series (L1, F8)

def _orders_series(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(_d("o_orderdate").alias("data_referencia"), "o_orderkey", "o_custkey", "o_orderstatus",
                    "o_totalprice")


SERIES_COLS = ("data_referencia", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _series(spark, sf) -> DateSeries:
    return DateSeries(lambda: _orders_series(spark, sf), SERIES_COLS, "data_referencia", ("o_orderkey",))


SQL_SERIES = ("SELECT CAST(o_orderdate AS DATE) AS data_referencia, o_orderkey, o_custkey, o_orderstatus, "
              "o_totalprice FROM orders")


# ----------------------------------------------------------- quotes × settlements

def quotes_gold(spark, sf) -> DataFrame:
    """Quote feed from lineitem → MERCADO_SECUNDARIO rows (keep first per key in landed order)."""
    li = table(spark, sf, "lineitem")
    d = _d("l_shipdate")
    silver_rows = li.select(
        F.col("l_linestatus").alias("tipo_titulo"), F.last_day(d).alias("data_vencimento"),
        d.alias("data_referencia"), F.col("l_discount").alias("taxa_anbima"),
        F.col("l_tax").alias("intervalo_min_d0"), F.col("l_quantity").alias("intervalo_max_d0"),
        F.lit(None).cast("double").alias("intervalo_min_d1"), F.lit(None).cast("double").alias("intervalo_max_d1"),
        F.col("l_extendedprice").alias("pu"), F.col("l_orderkey").cast("string").alias("codigo_selic"),
        F.col("l_returnflag").alias("codigo_isin"), _li_seq().alias("_seq"))
    return materialize(silver_rows, "mercado_secundario", "*", ["_seq"])


def settlements_gold(spark, sf) -> DataFrame:
    """Settlement feed from orders → LIQUIDACOES_MERCADO rows."""
    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    silver_rows = o.select(
        F.col("o_orderstatus").alias("tipo_titulo"), F.last_day(d).alias("data_vencimento"),
        d.alias("data_referencia"), F.col("o_custkey").alias("qtd_operacoes"),
        F.col("o_totalprice").alias("qtd_titulos"), F.col("o_totalprice").alias("pu_medio"),
        F.col("o_orderkey").cast("string").alias("codigo_selic"), F.col("o_orderpriority").alias("codigo_isin"),
        F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").alias("_seq"))
    return materialize(silver_rows, "liquidacoes_mercado", "*", ["_seq"])


def _combined(spark, sf) -> QuotesSettlements:
    return QuotesSettlements(lambda: quotes_gold(spark, sf), lambda: settlements_gold(spark, sf))


_LI_ORD_ASC = ", ".join(f"{c} NULLS FIRST" for c in LINEITEM_ORDER)
_LI_ORD_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in LINEITEM_ORDER)

SQL_QUOTES = f"""
SELECT tipo_titulo, data_vencimento, data_referencia, taxa_anbima, intervalo_min_d0, intervalo_max_d0,
       pu, codigo_selic, codigo_isin
FROM (
  SELECT l_linestatus AS tipo_titulo, last_day(CAST(l_shipdate AS DATE)) AS data_vencimento,
         CAST(l_shipdate AS DATE) AS data_referencia, l_discount AS taxa_anbima, l_tax AS intervalo_min_d0,
         l_quantity AS intervalo_max_d0, l_extendedprice AS pu, CAST(l_orderkey AS VARCHAR) AS codigo_selic,
         l_returnflag AS codigo_isin,
         row_number() OVER (PARTITION BY l_linestatus, last_day(CAST(l_shipdate AS DATE)), CAST(l_shipdate AS DATE)
                            ORDER BY {_LI_ORD_ASC}) AS rn
  FROM lineitem) WHERE rn = 1"""

SQL_SETTLEMENTS = """
SELECT tipo_titulo, data_vencimento, data_referencia, qtd_operacoes, qtd_titulos, pu_medio, codigo_selic,
       codigo_isin
FROM (
  SELECT o_orderstatus AS tipo_titulo, last_day(CAST(o_orderdate AS DATE)) AS data_vencimento,
         CAST(o_orderdate AS DATE) AS data_referencia, o_custkey AS qtd_operacoes, o_totalprice AS qtd_titulos,
         o_totalprice AS pu_medio, CAST(o_orderkey AS VARCHAR) AS codigo_selic, o_orderpriority AS codigo_isin,
         row_number() OVER (PARTITION BY o_orderstatus, last_day(CAST(o_orderdate AS DATE)), CAST(o_orderdate AS DATE)
                            ORDER BY o_orderkey NULLS FIRST, o_custkey NULLS FIRST, o_totalprice NULLS FIRST,
                                     o_orderpriority NULLS FIRST) AS rn
  FROM orders) WHERE rn = 1"""


def _sql_combined(where_q: str = "", where_s: str = "", prefix: str = "") -> str:
    return f"""{prefix}
SELECT COALESCE(q.tipo_titulo, s.tipo_titulo) AS tipo_titulo,
       COALESCE(q.data_vencimento, s.data_vencimento) AS data_vencimento,
       COALESCE(q.data_referencia, s.data_referencia) AS data_referencia,
       q.taxa_anbima, q.intervalo_min_d0, q.intervalo_max_d0, CAST(NULL AS DOUBLE) AS intervalo_min_d1,
       CAST(NULL AS DOUBLE) AS intervalo_max_d1, q.pu, CAST(NULL AS VARCHAR) AS expressao_mercado,
       CAST(NULL AS DATE) AS data_base_mercado, q.codigo_selic AS codigo_selic_mercado,
       q.codigo_isin AS codigo_isin_mercado, CAST(NULL AS DOUBLE) AS taxa_compra, CAST(NULL AS DOUBLE) AS taxa_venda,
       CAST(NULL AS DOUBLE) AS desvio_padrao,
       CASE WHEN q.tipo_titulo IS NOT NULL THEN 'ATIVO' END AS status_mercado,
       s.qtd_operacoes, s.qtd_titulos, s.pu_medio AS pu_medio_liq, CAST(NULL AS VARCHAR) AS expressao_liq,
       CAST(NULL AS DATE) AS data_base_liq, s.codigo_selic AS codigo_selic_liq, s.codigo_isin AS codigo_isin_liq,
       CASE WHEN s.tipo_titulo IS NOT NULL THEN 'ATIVO' END AS status_liq
FROM (SELECT * FROM ({SQL_QUOTES}) {where_q}) q
FULL OUTER JOIN (SELECT * FROM ({SQL_SETTLEMENTS}) {where_s}) s
  ON q.tipo_titulo = s.tipo_titulo AND q.data_vencimento = s.data_vencimento AND q.data_referencia = s.data_referencia
"""


_LATEST_COMBINED_CTE = f"""WITH latest AS (
  SELECT data_referencia FROM (
    SELECT CAST(l_shipdate AS DATE) AS data_referencia FROM lineitem
    UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
  GROUP BY data_referencia ORDER BY data_referencia DESC LIMIT {LATEST_N_COMBINED})"""

_IN_LATEST = "WHERE data_referencia IN (SELECT data_referencia FROM latest)"


# -------------------------------------------------------------------------------- dedup

def dedup_first(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_shipdate", _d("l_shipdate"))
    rest = [c for c in LINEITEM_ORDER if c not in ("l_orderkey", "l_linenumber")]
    return keep_first(li, ["l_orderkey", "l_linenumber"], rest)


def dedup_last(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_shipdate", _d("l_shipdate"))
    rest = [c for c in LINEITEM_ORDER if c not in ("l_orderkey", "l_linenumber")]
    return keep_last(li, ["l_orderkey", "l_linenumber"], rest)


_LI_COLS = ", ".join(c if c != "l_shipdate" else "CAST(l_shipdate AS DATE) AS l_shipdate" for c in LINEITEM_ORDER)
_REST = [c for c in LINEITEM_ORDER if c not in ("l_orderkey", "l_linenumber")]


def _sql_dedup(desc: bool) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" if desc else f"{c} NULLS FIRST" for c in _REST)
    return f"""SELECT {", ".join(LINEITEM_ORDER)} FROM (
  SELECT {_LI_COLS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM lineitem) WHERE rn = 1"""


# ------------------------------------------------------------------------ coercions

def _render_numeric() -> Column:
    k = F.col("o_orderkey") % 5
    ck, ok = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    return (F.when(k == 0, F.concat(ck, F.lit(","), (ok % 100).cast("string")))
            .when(k == 1, F.concat(ck, F.lit("."), (ok % 100).cast("string")))
            .when(k == 2, F.concat(F.lit("1."), ck, F.lit(","), (ok % 10).cast("string")))
            .when(k == 3, F.concat(F.lit("x"), ck))
            .otherwise(ck))


def numeric_coerce(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _render_numeric().alias("raw_text"))
    return o.select("o_orderkey", "raw_text", to_double(F.col("raw_text"), comma_decimal=True).alias("value_comma"),
                    to_double(F.col("raw_text")).alias("value_plain"))


SQL_NUMERIC = """
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey % 100 AS VARCHAR)
    WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.' || CAST(o_orderkey % 100 AS VARCHAR)
    WHEN 2 THEN '1.' || CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey % 10 AS VARCHAR)
    WHEN 3 THEN 'x' || CAST(o_custkey AS VARCHAR)
    ELSE CAST(o_custkey AS VARCHAR) END AS raw_text FROM orders)
SELECT o_orderkey, raw_text, TRY_CAST(trim(replace(raw_text, ',', '.')) AS DOUBLE) AS value_comma,
       TRY_CAST(trim(raw_text) AS DOUBLE) AS value_plain FROM r"""


def _render_date() -> Column:
    k, d = F.col("o_orderkey") % 8, _d("o_orderdate")
    return (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 1, F.date_format(d, "dd/MM/yyyy"))
            .when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00")))
            .when(k == 3, F.date_format(d, "MM/dd/yyyy"))
            .when(k == 4, F.date_format(d, "dd-MM-yyyy"))
            .when(k == 5, F.date_format(d, "yyyy/MM/dd"))
            .when(k == 6, F.lit("nan"))
            .otherwise(F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))))


def date_coerce(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _render_date().alias("raw_text"))
    return o.select("o_orderkey", "raw_text", to_date_any(F.col("raw_text")).alias("parsed"))


SQL_DATE = """
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
    WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
    WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || 'T10:00:00'
    WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y')
    WHEN 4 THEN strftime(CAST(o_orderdate AS DATE), '%d-%m-%Y')
    WHEN 5 THEN strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d')
    WHEN 6 THEN 'nan'
    ELSE 'x' || CAST(o_orderkey AS VARCHAR) END AS raw_text FROM orders),
t AS (SELECT o_orderkey, raw_text, trim(raw_text) AS s FROM r)
SELECT o_orderkey, raw_text, CAST(CASE WHEN lower(s) IN ('nan', 'nat', 'none', '') THEN NULL ELSE COALESCE(
    CASE WHEN length(s) >= 10 AND substr(s, 5, 1) = '-' AND substr(s, 8, 1) = '-'
         THEN try_strptime(substr(s, 1, 10), '%Y-%m-%d') END,
    try_strptime(s, '%d/%m/%Y'), try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%m/%d/%Y'),
    try_strptime(s, '%d-%m-%Y'), try_strptime(s, '%Y/%m/%d')) END AS DATE) AS parsed
FROM t"""


def _render_month() -> Column:
    k, d = F.col("o_orderkey") % 6, _d("o_orderdate")
    return (F.when(k == 0, F.date_format(d, "MM/yyyy"))
            .when(k == 1, F.date_format(d, "MM-yyyy"))
            .when(k == 2, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 3, F.date_format(d, "yyyyMM"))
            .when(k == 4, F.date_format(d, "yyyy-MM"))
            .otherwise(F.concat(F.lit("13/"), F.year(d).cast("string"))))


def month_coerce(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _render_month().alias("raw_text"))
    r = F.col("raw_text")
    return o.select("o_orderkey", "raw_text", month_to_date(r).alias("month_c4"),
                    month_partition_key(r).alias("month_c5"), yyyymm_to_date(r).alias("month_c6"))


SQL_MONTH = r"""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%m/%Y')
    WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%m-%Y')
    WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
    WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m')
    WHEN 4 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m')
    ELSE '13/' || CAST(year(o_orderdate) AS VARCHAR) END AS raw_text FROM orders),
t AS (SELECT o_orderkey, raw_text, trim(raw_text) AS s FROM r),
c AS (SELECT *, CAST(CASE
    WHEN regexp_matches(s, '^\d{1,2}[/-]\d{4}$') THEN try_strptime(
        regexp_extract(s, '^(\d{1,2})[/-](\d{4})$', 2) || '-' || lpad(regexp_extract(s, '^(\d{1,2})[/-](\d{4})$', 1), 2, '0')
        || '-01', '%Y-%m-%d')
    WHEN length(s) >= 10 AND substr(s, 5, 1) = '-' AND substr(s, 8, 1) = '-'
        THEN date_trunc('month', try_strptime(substr(s, 1, 10), '%Y-%m-%d')) END AS DATE) AS month_c4 FROM t)
SELECT o_orderkey, raw_text, month_c4,
       CAST(COALESCE(CASE WHEN regexp_matches(s, '^\d{4}-\d{2}$') THEN try_strptime(s || '-01', '%Y-%m-%d') END,
                     month_c4) AS DATE) AS month_c5,
       CAST(CASE WHEN regexp_matches(s, '^\d{6}$') THEN try_strptime(s, '%Y%m') END AS DATE) AS month_c6
FROM c"""


def slash_disambiguate(spark, sf):
    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy"))
    x = o.select("o_orderkey", raw.alias("raw_text"))
    allowed = o.where(F.col("o_orderpriority") == "1-URGENT").select(d.alias("ok"))
    return disambiguate_slash_dates(x, "raw_text", allowed, "ok", "parsed")


SQL_SLASH = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
                                   ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END AS raw_text FROM orders),
ok AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT'),
p AS (SELECT o_orderkey, raw_text, CAST(try_strptime(trim(raw_text), '%d/%m/%Y') AS DATE) AS dm,
             CAST(try_strptime(trim(raw_text), '%m/%d/%Y') AS DATE) AS md,
             CAST(try_strptime(substr(trim(raw_text), 1, 10), '%Y-%m-%d') AS DATE) AS iso FROM r)
SELECT o_orderkey, raw_text, CASE WHEN dm IN (SELECT d FROM ok) THEN dm WHEN md IN (SELECT d FROM ok) THEN md
                                  ELSE COALESCE(iso, dm, md) END AS parsed FROM p"""


def _render_decimal() -> Column:
    m = F.trunc(_d("o_orderdate"), "MM")
    ck, ok = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    comma_month = F.month(m) % 2 == 1
    return (F.when(comma_month & (ok % 7 == 0), F.concat(ck, F.lit("."), (ok % 10).cast("string")))
            .when(comma_month, F.concat(ck, F.lit(","), (ok % 100).cast("string")))
            .otherwise(F.concat(ck, F.lit("."), (ok % 100).cast("string"))))


def column_decimal_flag(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.trunc(_d("o_orderdate"), "MM").alias("reference_month"),
                                          _render_decimal().alias("raw_value"))
    return column_comma_decimal(o, "raw_value", ["reference_month"], "value")


SQL_DECIMAL = """
WITH r AS (SELECT o_orderkey, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS reference_month,
  CASE WHEN month(o_orderdate) % 2 = 1 AND o_orderkey % 7 = 0
         THEN CAST(o_custkey AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR)
       WHEN month(o_orderdate) % 2 = 1 THEN CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey % 100 AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) || '.' || CAST(o_orderkey % 100 AS VARCHAR) END AS raw_value FROM orders),
f AS (SELECT *, bool_or(contains(raw_value, ',')) OVER (PARTITION BY reference_month) AS has_comma FROM r)
SELECT o_orderkey, reference_month, raw_value,
       TRY_CAST(trim(CASE WHEN has_comma THEN replace(replace(raw_value, '.', ''), ',', '.') ELSE raw_value END)
                AS DOUBLE) AS value FROM f"""


# ------------------------------------------------------------------------------ PTAX

def _ptax_line() -> Column:
    e, u = F.col("event_id"), F.col("user_id")
    tipo = F.when(e % 3 == 0, F.lit("A")).when(e % 3 == 1, F.lit("B")).otherwise(F.lit(" A"))
    moeda = F.when(e % 4 == 0, F.lit("usd")).when(e % 4 == 1, F.lit("EUR")).otherwise(F.lit("USD"))
    compra = F.concat((u % 10).cast("string"), F.lit(","), F.lpad((e % 10000).cast("string"), 4, "0"))
    venda = F.concat((u % 10 + 1).cast("string"), F.lit(","), F.lpad((e % 9973).cast("string"), 4, "0"))
    lead = F.when(e % 7 == 0, F.lit("  ")).otherwise(F.lit(""))
    return F.concat(lead, F.date_format("ts", "ddMMyyyy"), F.lit(";220;"), tipo, F.lit(";"), moeda, F.lit(";"),
                    compra, F.lit(";"), venda, F.lit(";1,0000;1,0000"))


def ptax_parse(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_id").alias("seq"), _ptax_line().alias("line"))
    noise = table(spark, sf, "pages").select(F.lit(-1).cast("bigint").alias("seq"),
                                             F.explode(F.split("html", "\n")).alias("line"))
    parsed = parse_ptax_lines(ev.unionByName(noise), "line")
    fetched = combine_ptax(parsed, *PTAX_WINDOW, order=["seq"])
    return silver.ptax(fetched, carry=()).select("data_referencia", "ptax_compra", "ptax_venda")


SQL_PTAX = f"""
WITH lines AS (
  SELECT event_id AS seq,
    (CASE WHEN event_id % 7 = 0 THEN '  ' ELSE '' END) || strftime(ts, '%d%m%Y') || ';220;' ||
    (CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE ' A' END) || ';' ||
    (CASE event_id % 4 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE 'USD' END) || ';' ||
    CAST(user_id % 10 AS VARCHAR) || ',' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') || ';' ||
    CAST(user_id % 10 + 1 AS VARCHAR) || ',' || lpad(CAST(event_id % 9973 AS VARCHAR), 4, '0') || ';1,0000;1,0000'
    AS line FROM events
  UNION ALL SELECT -1 AS seq, unnest(string_split(html, chr(10))) AS line FROM pages),
ok AS (SELECT seq, trim(line) AS line FROM lines WHERE regexp_matches(trim(line), '^\\d{{8}};')),
parsed AS (SELECT seq, CAST(try_strptime(split_part(line, ';', 1), '%d%m%Y') AS DATE) AS data,
                  split_part(line, ';', 3) AS tipo, split_part(line, ';', 4) AS moeda,
                  TRY_CAST(replace(split_part(line, ';', 5), ',', '.') AS DOUBLE) AS compra,
                  TRY_CAST(replace(split_part(line, ';', 6), ',', '.') AS DOUBLE) AS venda FROM ok),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY data ORDER BY seq) AS rn
                          FROM parsed WHERE data IS NOT NULL) WHERE rn = 1)
SELECT data AS data_referencia, compra AS ptax_compra, venda AS ptax_venda FROM firsts
WHERE data BETWEEN DATE '{PTAX_WINDOW[0]}' AND DATE '{PTAX_WINDOW[1]}'
  AND trim(tipo) = 'A' AND upper(trim(moeda)) = 'USD'"""


# -------------------------------------------------------------------- pivot, month expansion

def _long_rows(spark, sf):
    o = table(spark, sf, "orders")
    var = F.when(F.col("o_orderstatus") == "F", "2266").when(F.col("o_orderstatus") == "O", "63").otherwise("99")
    return o.select(F.trunc(_d("o_orderdate"), "MM").alias("ref_month"), var.alias("var"),
                    F.col("o_totalprice").alias("value"))


def dup_keys(spark, sf):
    return duplicate_keys(_long_rows(spark, sf), ["ref_month", "var"])


def pivot_monthly(spark, sf):
    agg = _long_rows(spark, sf).groupBy("ref_month", "var").agg(F.max("value").alias("value"))
    return pivot_long(agg, "ref_month", "var", "value", {"2266": "ipca_index", "63": "ipca_mom"})


_SQL_LONG = """SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS ref_month,
  CASE o_orderstatus WHEN 'F' THEN '2266' WHEN 'O' THEN '63' ELSE '99' END AS var, o_totalprice AS value FROM orders"""

SQL_DUP_KEYS = f"SELECT ref_month, var, CAST(count(*) AS BIGINT) AS n FROM ({_SQL_LONG}) GROUP BY 1, 2 HAVING count(*) > 1"
SQL_PIVOT = f"""SELECT ref_month, max(CASE WHEN var = '2266' THEN value END) AS ipca_index,
  max(CASE WHEN var = '63' THEN value END) AS ipca_mom FROM ({_SQL_LONG}) WHERE var IN ('2266', '63') GROUP BY 1"""


def month_to_business_day(spark, sf):
    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    bounds = o.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = cal.days_between(bounds, "lo", "hi", "data_referencia").select("data_referencia") \
        .where(cal.is_weekday(F.col("data_referencia")))
    monthly = o.groupBy(F.trunc(d, "MM").alias("ref_month")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"))
    return monthly_as_daily(days, "data_referencia", monthly, "ref_month")


SQL_MONTH_DAILY = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS data_referencia FROM b),
m AS (SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS reference_month,
             CAST(count(*) AS BIGINT) AS n_orders, max(o_totalprice) AS max_price, min(o_totalprice) AS min_price
      FROM orders GROUP BY 1)
SELECT d.data_referencia, CAST(date_trunc('month', d.data_referencia) AS DATE) AS reference_month,
       m.n_orders, m.max_price, m.min_price
FROM days d LEFT JOIN m ON m.reference_month = CAST(date_trunc('month', d.data_referencia) AS DATE)
WHERE isodow(d.data_referencia) < 6"""


# ------------------------------------------------------------------------------ nested

_VNA_PAYLOAD = "array<map<string,string>>"


def explode_titles(spark, sf):
    li = table(spark, sf, "lineitem")
    d = _d("l_shipdate")
    first = F.struct(F.col("l_partkey").alias("codigo_selic"), F.col("l_returnflag").alias("tipo_correcao"),
                     F.col("l_discount").alias("index"), d.cast("string").alias("data_validade"),
                     F.col("l_extendedprice").alias("vna"), F.lit(None).cast("string").alias("data_referencia"))
    second = F.struct(F.col("l_suppkey").alias("codigo_selic"), F.col("l_linestatus").alias("tipo_correcao"),
                      F.col("l_tax").alias("index"), F.date_add(d, 30).cast("string").alias("data_validade"),
                      F.col("l_quantity").alias("vna"),
                      F.date_add(d, F.col("l_linenumber")).cast("string").alias("data_referencia"))
    payload = F.to_json(F.struct(d.cast("string").alias("data_referencia"), F.array(first, second).alias("titulos")))
    # Rows of one order and line number are told apart by their place among them: titles are ranked by three numbers, not by the
    # whole row, which every title would take through the shuffle and its sorts.
    keys = ("l_orderkey", "l_linenumber")
    among = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in LINEITEM_ORDER if c not in keys])
    landed = li.withColumn("_among", F.row_number().over(among)).select(F.struct(*keys, "_among").alias("_seq"), payload.alias("payload"))
    records = landed.select("_seq", F.explode_outer(F.from_json(F.concat(F.lit("["), "payload", F.lit("]")), _VNA_PAYLOAD)).alias("rec"))
    rows = silver.vna_records(records, "rec", ["_seq"])
    return silver.vna(rows, order=["_seq", "_pos"])


SQL_EXPLODE = f"""
WITH base AS (SELECT *, CAST(l_shipdate AS DATE) AS sd FROM lineitem),
kids AS (
  SELECT sd AS data_referencia, l_partkey AS codigo_selic, l_returnflag AS tipo_correcao, l_discount AS "index",
         sd AS data_validade, l_extendedprice AS vna, 0 AS pos, {", ".join(LINEITEM_ORDER)} FROM base
  UNION ALL
  SELECT CAST(sd + l_linenumber AS DATE), l_suppkey, l_linestatus, l_tax, CAST(sd + 30 AS DATE), l_quantity, 1,
         {", ".join(LINEITEM_ORDER)} FROM base),
ranked AS (SELECT *, row_number() OVER (PARTITION BY data_referencia, codigo_selic
                                        ORDER BY {_LI_ORD_DESC}, pos DESC) AS rn FROM kids)
SELECT data_referencia, codigo_selic, tipo_correcao, "index", data_validade, vna FROM ranked WHERE rn = 1"""


# ------------------------------------------------------------------------------- newest file

def newest_file(spark, sf):
    ev = table(spark, sf, "events")
    name = F.when(F.col("event_type") == "error", F.lit("log_error.csv")) \
        .otherwise(F.concat(F.lit("ajustes_"), F.col("event_type"), F.lit(".csv")))
    rows = ev.select(_d("ts").alias("day"), name.alias("file_name"), F.col("ts").alias("mtime"), "event_id", "value")
    return newest_file_rows(rows, "day", "file_name", "mtime", "ajustes_").select("day", "file_name", "event_id",
                                                                                  "value")


SQL_NEWEST = """
WITH r AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN 'log_error.csv'
                  ELSE 'ajustes_' || event_type || '.csv' END AS file_name, ts, event_id, value FROM events),
f AS (SELECT day, file_name, max(ts) AS mt FROM r WHERE starts_with(file_name, 'ajustes_') GROUP BY 1, 2),
pick AS (SELECT day, file_name FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY mt DESC, file_name DESC)
                                     AS rn FROM f) WHERE rn = 1)
SELECT r.day, r.file_name, r.event_id, r.value FROM r JOIN pick USING (day, file_name)"""


# ----------------------------------------------------------------------- business days

def _holidays(o: DataFrame) -> tuple[DataFrame, DataFrame]:
    d = _d("o_orderdate")
    bounds = o.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = cal.days_between(bounds, "lo", "hi", "d").select("d")
    hol = days.where(cal.is_weekday(F.col("d")) & F.expr(HOLIDAY.format(d="d"))).select(F.col("d").alias("data"))
    return days, hol


def business_day_shift(spark, sf):
    o = table(spark, sf, "orders")
    days, hol = _holidays(o)
    idx = cal.business_day_index_over(cal.spine_for(days, "d", 5), hol)
    x = days.join(idx.select("d", "is_bday"), "d")
    x = cal.shift_business_days(x, "d", 1, idx, "next_bday")
    x = cal.shift_business_days(x, "d", -1, idx, "prev_bday")
    x = cal.shift_business_days(x, "d", 5, idx, "plus_5")
    x = cal.roll_forward(x, "d", idx, "rolled")
    return x.select(F.col("d").alias("data_referencia"), "is_bday", "next_bday", "prev_bday", "plus_5", "rolled")


def month_15th(spark, sf):
    o = table(spark, sf, "orders")
    days, hol = _holidays(o)
    idx = cal.business_day_index_over(cal.spine_for(days, "d"), hol)
    months = days.select(F.trunc("d", "MM").alias("month")).distinct()
    return cal.business_15th(months, "month", idx, "bday15")


_SQL_CAL = f"""
od AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (SELECT min(d) AS lo, max(d) AS hi FROM od),
spine AS (SELECT CAST(unnest(generate_series(lo - INTERVAL 40 DAY, hi + INTERVAL 120 DAY, INTERVAL 1 DAY)) AS DATE)
          AS d FROM b),
flag AS (SELECT s.d, (isodow(s.d) < 6 AND NOT (s.d BETWEEN b.lo AND b.hi AND {HOLIDAY.format(d='s.d')}))
                AS bd FROM spine s CROSS JOIN b)"""

SQL_BDAY_SHIFT = f"""WITH {_SQL_CAL},
w AS (SELECT d, bd,
        min(CASE WHEN bd THEN d END) OVER (ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_bday,
        max(CASE WHEN bd THEN d END) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_bday,
        min(CASE WHEN bd THEN d END) OVER (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rolled
      FROM flag),
bl AS (SELECT d, lead(d, 4) OVER (ORDER BY d) AS plus4 FROM flag WHERE bd)
SELECT w.d AS data_referencia, w.bd AS is_bday, w.next_bday, w.prev_bday, bl.plus4 AS plus_5, w.rolled
FROM w CROSS JOIN b LEFT JOIN bl ON bl.d = w.next_bday WHERE w.d BETWEEN b.lo AND b.hi"""

SQL_MONTH_15TH = f"""WITH {_SQL_CAL},
months AS (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month FROM od)
SELECT m.month, (SELECT min(f.d) FROM flag f WHERE f.bd AND f.d >= CAST(m.month + INTERVAL 14 DAY AS DATE)) AS bday15
FROM months m"""


# ------------------------------------------------------------------------- daily inflation

def _ipca_inputs(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    d = _d("o_orderdate")
    index = o.groupBy(F.trunc(d, "MM").alias("ref_month")).agg(
        F.max("o_totalprice").alias("ipca_index"), F.min("o_totalprice").alias("ipca_mom")) \
        .withColumn("_seq", F.struct("ref_month"))
    sd = _d("l_shipdate")
    coleta = F.make_date(F.year(sd), F.month(sd), F.when(F.dayofmonth(sd) <= 12, F.lit(5)).otherwise(F.lit(20)))
    proj = li.select(
        F.when(F.col("l_returnflag") == "R", F.lit("IGP-M")).otherwise(F.lit("ipca")).alias("indice"),
        F.when(F.col("l_linestatus") == "O", F.lit(PROJ_TIPO)).otherwise(F.lit(NEXT_TIPO)).alias("tipo_projecao"),
        coleta.alias("data_coleta"), F.trunc(sd, "MM").alias("ref_month"),
        F.col("l_discount").alias("variacao_projetada"), _li_seq().alias("_seq"))
    days, hol = _holidays(o)
    return days.select(F.col("d").alias("data_referencia")), index, proj, hol


def ipca_daily(spark, sf):
    days, index, proj, hol = _ipca_inputs(spark, sf)
    return build_ipca_daily(days, index, proj, hol)


SQL_IPCA = f"""WITH {_SQL_CAL},
idx AS (SELECT CAST(date_trunc('month', d) AS DATE) AS ref_month, max(o_totalprice) AS ipca_index,
               min(o_totalprice) AS ipca_mom
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders) GROUP BY 1),
proj AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'IGP-M' ELSE 'ipca' END AS indice,
                CASE WHEN l_linestatus = 'O' THEN '{PROJ_TIPO}' ELSE '{NEXT_TIPO}' END AS tipo,
                make_date(year(l_shipdate), month(l_shipdate), CASE WHEN day(l_shipdate) <= 12 THEN 5 ELSE 20 END)
                  AS coleta,
                CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS ref_month,
                l_discount AS v,
                row_number() OVER (ORDER BY {_LI_ORD_ASC}) AS seq
         FROM lineitem),
days AS (SELECT s.d, CAST(date_trunc('month', s.d) AS DATE) AS m0 FROM spine s CROSS JOIN b WHERE s.d BETWEEN b.lo AND b.hi),
m0s AS (SELECT DISTINCT m0 FROM days),
b15 AS (SELECT m.m, (SELECT min(f.d) FROM flag f WHERE f.bd AND f.d >= CAST(m.m + INTERVAL 14 DAY AS DATE)) AS b15
        FROM (SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS m FROM spine) m),
islice AS (SELECT m0, ref_month FROM (
             SELECT m0s.m0, i.ref_month, row_number() OVER (PARTITION BY m0s.m0 ORDER BY i.ref_month DESC) AS r
             FROM m0s JOIN (SELECT DISTINCT ref_month FROM idx) i ON i.ref_month <= m0s.m0) WHERE r <= 3),
pslice AS (SELECT m0, ref_month FROM (
             SELECT m0s.m0, p.ref_month, row_number() OVER (PARTITION BY m0s.m0 ORDER BY p.ref_month DESC) AS r
             FROM m0s JOIN (SELECT DISTINCT ref_month FROM proj WHERE ref_month IS NOT NULL) p
               ON p.ref_month <= m0s.m0) WHERE r <= 3),
cand AS (SELECT ps.m0, p.coleta, p.v, p.seq FROM proj p JOIN pslice ps ON ps.ref_month = p.ref_month
         WHERE upper(p.indice) = 'IPCA' AND p.tipo = '{PROJ_TIPO}' AND p.coleta IS NOT NULL),
pick AS (SELECT d, m0, coleta, v FROM (
           SELECT days.d, days.m0, c.coleta, c.v,
                  row_number() OVER (PARTITION BY days.d ORDER BY (c.coleta <= days.d) DESC, c.coleta DESC, c.seq) AS r
           FROM days JOIN cand c ON c.m0 = days.m0) WHERE r = 1),
cl AS (SELECT *, CAST(CASE WHEN d >= coleta THEN date_trunc('month', coleta) - INTERVAL 1 MONTH
                           ELSE date_trunc('month', coleta) - INTERVAL 2 MONTH END AS DATE) AS ultimo FROM pick),
sl AS (SELECT s.m0, s.ref_month, i.ipca_index, i.ipca_mom,
              lag(s.ref_month) OVER w AS prev_month, lag(i.ipca_index) OVER w AS prev_index,
              lag(i.ipca_mom) OVER w AS prev_mom
       FROM islice s JOIN idx i ON i.ref_month = s.ref_month WINDOW w AS (PARTITION BY s.m0 ORDER BY s.ref_month)),
j AS (SELECT cl.*, sl.ipca_index AS a, sl.ipca_mom AS a_mom,
             CASE WHEN sl.prev_month IS NULL THEN sl.ref_month ELSE sl.prev_month END AS ant_month,
             CASE WHEN sl.prev_month IS NULL THEN sl.ipca_index ELSE sl.prev_index END AS bb,
             CASE WHEN sl.prev_month IS NULL THEN sl.ipca_mom ELSE sl.prev_mom END AS b_mom,
             cur.b15 AS b15_cur, prv.b15 AS b15_prev, nxt.b15 AS b15_next
      FROM cl JOIN sl ON sl.m0 = cl.m0 AND sl.ref_month = cl.ultimo
      LEFT JOIN b15 cur ON cur.m = cl.m0
      LEFT JOIN b15 prv ON prv.m = CAST(cl.m0 - INTERVAL 1 MONTH AS DATE)
      LEFT JOIN b15 nxt ON nxt.m = CAST(cl.m0 + INTERVAL 1 MONTH AS DATE)),
u AS (SELECT *, coalesce(ultimo = CAST(m0 - INTERVAL 1 MONTH AS DATE) AND d < b15_cur AND coalesce(a <> bb, true),
                         false) AS usa FROM j)
SELECT d AS data_referencia, CAST(month(ultimo) AS VARCHAR) AS ultimo_mes_ipca, ultimo AS ref_month_atual,
       ant_month AS ref_month_anterior, CAST(1614.62 AS DOUBLE) AS indice_ipca_data_base, a AS indice_ipca_fechado_atual,
       bb AS indice_ipca_fechado_anterior, a_mom AS var_ipca_atual, b_mom AS var_ipca_ant, v AS ipca_proj,
       CASE WHEN usa THEN (a / bb - 1) * 100 ELSE v END AS ipca_usado, CAST(usa AS INTEGER) AS usa_fechado,
       coleta AS data_coleta_referencia, coleta AS ipca_proj_data_coleta,
       CASE WHEN d < b15_cur THEN b15_prev ELSE b15_cur END AS inicio_mes_ipca,
       CASE WHEN d < b15_cur THEN b15_cur ELSE b15_next END AS fim_mes_ipca
FROM u"""


# ----------------------------------------------------------------------------- sinks

def _order_rows(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice", _d("o_orderdate").alias("data_referencia"))


def upsert_merge(spark, sf):
    o = table(spark, sf, "orders")
    base = _order_rows(o).where(F.col("data_referencia") < F.lit(UPSERT_BASE_BEFORE).cast("date"))
    batch = _order_rows(o).where(F.col("data_referencia") >= F.lit(UPSERT_BATCH_FROM).cast("date")) \
        .withColumn("o_orderstatus", F.lower("o_orderstatus")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return merge_by_key(base, batch, ["o_orderkey"])


SQL_UPSERT = f"""
WITH base AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS data_referencia, 0 AS batch
              FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{UPSERT_BASE_BEFORE}'),
upd AS (SELECT o_orderkey, lower(o_orderstatus), o_totalprice * 2, CAST(o_orderdate AS DATE), 1 FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '{UPSERT_BATCH_FROM}'),
u AS (SELECT * FROM base UNION ALL SELECT * FROM upd)
SELECT o_orderkey, o_orderstatus, o_totalprice, data_referencia FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY batch DESC) AS rn FROM u) WHERE rn = 1"""


def snapshot_replace(spark, sf):
    o = table(spark, sf, "orders")
    _, hol = _holidays(o)
    # The new snapshot arrives as text with a time part; the sink keeps the first 10 characters.
    new = hol.select(F.concat(F.col("data").cast("string"), F.lit(" 00:00:00")).alias("data"))
    from cupom.plans.gold import holidays_gold

    return holidays_gold(new, "data")


SQL_SNAPSHOT = f"""WITH {_SQL_CAL}
SELECT DISTINCT f.d AS data FROM flag f CROSS JOIN b
WHERE f.d BETWEEN b.lo AND b.hi AND isodow(f.d) < 6 AND NOT f.bd"""


def _existing_dim(spark, sf) -> DataFrame:
    q = quotes_gold(spark, sf)
    return bond_dimension_batch(q, ["data_referencia"], "replace")


def _auction_facts(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    return o.select(F.col("o_orderstatus").alias("tipo_titulo"), F.last_day(d).alias("data_vencimento"),
                    d.alias("data_referencia"), F.col("o_orderkey"))


def dim_replace(spark, sf):
    existing = _existing_dim(spark, sf)
    batch = bond_dimension_batch(_auction_facts(spark, sf), ["data_referencia", "o_orderkey"], "replace")
    return merge_by_key(existing, batch, ["tipo_titulo", "data_vencimento"])


def dim_coalesce(spark, sf):
    existing = _existing_dim(spark, sf)
    batch = bond_dimension_batch(_auction_facts(spark, sf), ["data_referencia", "o_orderkey"], "coalesce", existing)
    return merge_by_key(existing, batch, ["tipo_titulo", "data_vencimento"])


_SQL_DIM = f"""
q AS ({SQL_QUOTES}),
ex AS (SELECT tipo_titulo, data_vencimento, codigo_selic, codigo_isin FROM (
         SELECT *, row_number() OVER (PARTITION BY tipo_titulo, data_vencimento ORDER BY data_referencia DESC) AS rn
         FROM q) WHERE rn = 1),
au AS (SELECT DISTINCT o_orderstatus AS tipo_titulo, last_day(CAST(o_orderdate AS DATE)) AS data_vencimento
       FROM orders)"""

SQL_DIM_REPLACE = f"""WITH {_SQL_DIM}
SELECT tipo_titulo, data_vencimento, CAST(NULL AS VARCHAR) AS expressao, CAST(NULL AS DATE) AS data_base,
       CASE WHEN au.tipo_titulo IS NULL THEN ex.codigo_selic END AS codigo_selic,
       CASE WHEN au.tipo_titulo IS NULL THEN ex.codigo_isin END AS codigo_isin, 'ATIVO' AS status
FROM ex FULL OUTER JOIN au USING (tipo_titulo, data_vencimento)"""

SQL_DIM_COALESCE = f"""WITH {_SQL_DIM}
SELECT tipo_titulo, data_vencimento, CAST(NULL AS VARCHAR) AS expressao, CAST(NULL AS DATE) AS data_base,
       ex.codigo_selic, ex.codigo_isin, 'ATIVO' AS status
FROM ex FULL OUTER JOIN au USING (tipo_titulo, data_vencimento)"""


def merge_revisions_q(spark, sf):
    ev = table(spark, sf, "events")
    rec = ev.select(F.col("event_type").alias("indice"),
                    F.concat(F.lit("  "), (F.col("user_id") % 3).cast("string"), F.lit(" ")).alias("tipo_projecao"),
                    _d("ts").cast("string").alias("data_coleta"), F.date_format("ts", "MM/yyyy").alias("mes_referencia"),
                    F.col("value").alias("variacao_projetada"), "event_id", "ts")
    existing = rec.where(F.col("ts") < F.lit(REVISIONS_EXISTING_BEFORE).cast("timestamp_ntz")).drop("ts")
    new = rec.where(F.col("ts") >= F.lit(REVISIONS_NEW_FROM).cast("timestamp_ntz")).drop("ts")
    return merge_revisions(existing, new, ["event_id"]).drop("event_id")


SQL_REVISIONS = f"""
WITH rec AS (SELECT event_type AS indice, '  ' || CAST(user_id % 3 AS VARCHAR) || ' ' AS tipo_projecao,
                    CAST(CAST(ts AS DATE) AS VARCHAR) AS data_coleta, strftime(ts, '%m/%Y') AS mes_referencia,
                    value AS variacao_projetada, event_id, ts FROM events),
u AS (SELECT *, 0 AS prio FROM rec WHERE ts < TIMESTAMP '{REVISIONS_EXISTING_BEFORE}'
      UNION ALL SELECT *, 1 AS prio FROM rec WHERE ts >= TIMESTAMP '{REVISIONS_NEW_FROM}')
SELECT indice, tipo_projecao, data_coleta, mes_referencia, variacao_projetada FROM (
  SELECT *, row_number() OVER (PARTITION BY trim(indice), trim(tipo_projecao), trim(data_coleta), trim(mes_referencia)
                               ORDER BY prio, event_id) AS rn FROM u) WHERE rn = 1"""


# ------------------------------------------------------------------ coverage, gaps, staleness (M10, I*)

def coverage_check(spark, sf):
    li = table(spark, sf, "lineitem")
    d = _d("l_shipdate")
    bounds = li.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    requested = cal.days_between(bounds, "lo", "hi", "data_referencia").select("data_referencia") \
        .where(cal.is_weekday(F.col("data_referencia")))
    loaded = li.select(d.alias("data_referencia"))
    found = li.groupBy(d.alias("data_referencia")).agg(F.sum("l_partkey").alias("n")).where("n % 4 <> 1")
    return coverage_gaps(requested, loaded, found, "data_referencia")


SQL_COVERAGE = """
WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
req AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS data_referencia FROM b)
SELECT data_referencia FROM req
WHERE isodow(data_referencia) < 6
  AND data_referencia IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)
  AND data_referencia NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem
                              GROUP BY CAST(l_shipdate AS DATE) HAVING sum(l_partkey) % 4 <> 1)"""


def gap_report(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    od = _d("o_orderdate")
    bounds = o.agg(F.min(od).alias("lo"), F.max(od).alias("hi"))
    bdays = cal.days_between(bounds, "lo", "hi", "value").select("value").where(cal.is_weekday(F.col("value")))
    expected = bdays.select(F.lit("liquidacoes_mercado").alias("dataset"), "value") \
        .unionByName(bdays.select(F.lit("mercado_secundario").alias("dataset"), "value"))
    # A day's partition counts as present unless its key sum is a multiple of seven.
    per_day = o.groupBy(F.lit("liquidacoes_mercado").alias("dataset"), od.alias("value")).agg(F.sum("o_custkey").alias("n")) \
        .unionByName(li.groupBy(F.lit("mercado_secundario").alias("dataset"), _d("l_shipdate").alias("value")).agg(F.sum("l_partkey").alias("n")))
    return gap_rows(expected, per_day.where("n % 7 <> 0"))


SQL_GAPS = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
bd AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS value FROM b)
SELECT 'liquidacoes_mercado' AS dataset, value FROM bd
WHERE isodow(value) < 6 AND value NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders
                                          GROUP BY CAST(o_orderdate AS DATE) HAVING sum(o_custkey) % 7 <> 0)
UNION ALL
SELECT 'mercado_secundario' AS dataset, value FROM bd
WHERE isodow(value) < 6 AND value NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem
                                          GROUP BY CAST(l_shipdate AS DATE) HAVING sum(l_partkey) % 7 <> 0)"""


def stale_partitions_q(spark, sf):
    ev = table(spark, sf, "events")
    days = ev.groupBy(_d("ts").alias("value")).agg(F.max("ts").alias("last"), F.min("ts").alias("first"), F.count("*").alias("n"))
    # By a day's event count its silver is missing, older than bronze, or as new.
    silver_m = days.where("n % 3 <> 0").select("value", F.expr("CASE n % 3 WHEN 1 THEN first ELSE last END").alias("mtime"))
    return stale_partitions(days.select("value", F.col("last").alias("mtime")), silver_m)


SQL_STALE = """
SELECT CAST(ts AS DATE) AS value, CASE WHEN count(*) % 3 = 0 THEN 'missing' ELSE 'newer' END AS reason FROM events
GROUP BY 1 HAVING count(*) % 3 = 0 OR (count(*) % 3 = 1 AND max(ts) > min(ts))"""


# ----------------------------------------------------------------------- refresh (V1–V3, V5)

def _refresh_dates(o: DataFrame) -> DataFrame:
    return o.groupBy(_d("o_orderdate").alias("d")).agg(F.sum("o_custkey").alias("n")).where("n % 5 = 0").select("d")


def refresh_scope_q(spark, sf):
    o = table(spark, sf, "orders")
    return refresh_scope(_refresh_dates(o), *REFRESH_WINDOW)


SQL_REFRESH = f"""
WITH r AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
           WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{REFRESH_WINDOW[0]}' AND DATE '{REFRESH_WINDOW[1]}'
           GROUP BY 1 HAVING sum(o_custkey) % 5 = 0)
SELECT 'daily' AS scope, d AS value FROM r
UNION ALL SELECT DISTINCT 'monthly', CAST(date_trunc('month', d) AS DATE) FROM r
UNION ALL SELECT 'ipca_dict', CAST(unnest(generate_series(CAST(date_trunc('month', min(d)) AS DATE),
                                               DATE '{REFRESH_WINDOW[1]}', INTERVAL 1 DAY)) AS DATE) FROM r"""


def gold_delete(spark, sf):
    o = table(spark, sf, "orders")
    return delete_dates(_orders_series(spark, sf), "data_referencia", _refresh_dates(o), *REFRESH_WINDOW)


SQL_GOLD_DELETE = f"""{SQL_SERIES}
WHERE CAST(o_orderdate AS DATE) NOT IN (
  SELECT CAST(o_orderdate AS DATE) FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{REFRESH_WINDOW[0]}' AND DATE '{REFRESH_WINDOW[1]}'
  GROUP BY 1 HAVING sum(o_custkey) % 5 = 0)"""


# ------------------------------------------------------------------------ constraints

def constraints_q(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    a = constraint_violations(li, "lineitem", ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_quantity"],
                              {"l_linestatus": ("F", "O"), "l_returnflag": ("A", "N")})
    b = constraint_violations(o, "orders", ["o_orderkey"], ["o_orderdate"], {"o_orderstatus": ("F", "O")})
    return a.unionByName(b)


SQL_CONSTRAINTS = """
SELECT 'lineitem' AS table_name, 'not_null:l_shipdate' AS check_name, CAST(count(*) - count(l_shipdate) AS BIGINT)
  AS n_violations FROM lineitem
UNION ALL SELECT 'lineitem', 'not_null:l_quantity', CAST(count(*) - count(l_quantity) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'in:l_linestatus', CAST(count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O')) AS BIGINT)
  FROM lineitem
UNION ALL SELECT 'lineitem', 'in:l_returnflag', CAST(count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS BIGINT)
  FROM lineitem
UNION ALL SELECT 'lineitem', 'pk_not_null:l_orderkey', CAST(count(*) - count(l_orderkey) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'pk_not_null:l_linenumber', CAST(count(*) - count(l_linenumber) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'pk_unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'not_null:o_orderdate', CAST(count(*) - count(o_orderdate) AS BIGINT) FROM orders
UNION ALL SELECT 'orders', 'in:o_orderstatus', CAST(count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS BIGINT)
  FROM orders
UNION ALL SELECT 'orders', 'pk_not_null:o_orderkey', CAST(count(*) - count(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'orders', 'pk_unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"""


# ------------------------------------------------------------------- more feeds

def time_series(spark, sf):
    """(dd/MM/yyyy, value text) records, first per date in landed order, sorted."""
    ev = table(spark, sf, "events")
    recs = ev.select(F.date_format("ts", "dd/MM/yyyy").alias("data"), F.col("value").cast("string").alias("valor"),
                     F.col("event_type").alias("_file"), F.col("event_id").alias("_pos"))
    return landing_mod.time_series_records(recs)


SQL_TIME_SERIES = """
SELECT d AS data, value AS valor FROM (
  SELECT CAST(ts AS DATE) AS d, value, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_type, event_id)
         AS rn FROM events) WHERE rn = 1"""


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def ipca_silver(spark, sf):
    """S18 (abbreviated layout) + C10 + C6 + G1 + G2: one landed table per month; odd months use
    decimal commas with thousands dots, and their second variable is written with a dot (which the
    column-wide rule turns into a ×100 value, as upstream)."""
    agg = _long_rows(spark, sf).groupBy("ref_month", "var").agg(F.max("value").alias("value"))
    c = _cents()
    comma = F.concat(F.when(c >= 100000, F.concat((c / 100000).cast("bigint").cast("string"), F.lit("."),
                                                  F.lpad(((c / 100).cast("bigint") % 1000).cast("string"), 3, "0")))
                     .otherwise((c / 100).cast("bigint").cast("string")),
                     F.lit(","), F.lpad((c % 100).cast("string"), 2, "0"))
    dot = F.concat((c / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))
    odd = F.month("ref_month") % 2 == 1
    text = F.when(odd & (F.col("var") == "2266"), comma).otherwise(dot)
    landed = agg.select(F.date_format("ref_month", "yyyyMM").alias("D2C"), F.col("var").alias("D3C"),
                        text.alias("V"), F.date_format("ref_month", "yyyyMM").alias("_file"))
    return silver.ipca_indice(landed)


SQL_IPCA_SILVER = f"""
WITH a AS (SELECT ref_month, var, CAST(round(max(value) * 100) AS BIGINT) AS cents FROM ({_SQL_LONG}) GROUP BY 1, 2),
v AS (SELECT ref_month, var,
        CASE WHEN month(ref_month) % 2 = 1 AND var = '63' THEN CAST(cents AS DOUBLE) ELSE cents / 100.0 END AS val
      FROM a WHERE var IN ('2266', '63'))
SELECT ref_month, max(CASE WHEN var = '2266' THEN val END) AS ipca_index,
       max(CASE WHEN var = '63' THEN val END) AS ipca_mom FROM v GROUP BY ref_month"""


def _futures_gold(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    sd = _d("l_shipdate")
    family = F.when(F.col("l_returnflag") == "A", "DI1").when(F.col("l_returnflag") == "N", "DAP").otherwise("WIN")
    ticker = F.concat(family, F.col("l_linestatus"), (F.col("l_partkey") % 40).cast("string"))
    raw = li.select(F.date_format(sd, "dd/MM/yyyy").alias("RptDt"), ticker.alias("TckrSymb"),
                    F.concat(F.lit("BR"), ticker).alias("ISIN"),
                    F.date_format(F.make_date(F.year(sd) + 1, F.lit(1), F.lit(1)), "yyyy-MM-dd").alias("XprtnDt"),
                    F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(","),
                             F.col("l_linenumber").cast("string")).alias("AdjstdQtTax"),
                    F.col("l_suppkey").cast("string").alias("AdjstdQt"), _li_seq().alias("_seq"))
    return materialize(silver.ajustes_bmf(raw), "bmf", "*", ["_seq"])


def futures_adjustments(spark, sf):
    from cupom.plans.gold import adjustments_from_facts

    return adjustments_from_facts(_futures_gold(spark, sf))


def futures_contracts(spark, sf):
    from cupom.plans.gold import contracts_from_facts

    return contracts_from_facts(_futures_gold(spark, sf), ["data_referencia"])


_SQL_FUTURES = f"""
WITH s AS (SELECT CAST(l_shipdate AS DATE) AS d,
                  CASE l_returnflag WHEN 'A' THEN 'DI1' WHEN 'N' THEN 'DAP' ELSE 'WIN' END || l_linestatus
                    || CAST(l_partkey % 40 AS VARCHAR) AS ticker,
                  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) AS tax_txt,
                  l_suppkey, make_date(year(l_shipdate) + 1, 1, 1) AS venc, {", ".join(LINEITEM_ORDER)}
           FROM lineitem),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d, ticker ORDER BY {_LI_ORD_ASC}) AS rn FROM s
                     WHERE starts_with(ticker, 'DAP') OR starts_with(ticker, 'DI1')) WHERE rn = 1)"""

SQL_FUTURES_ADJ = f"""{_SQL_FUTURES}
SELECT ticker, d AS data_referencia, TRY_CAST(replace(tax_txt, ',', '.') AS DOUBLE) AS taxa_ajuste,
       CAST(l_suppkey AS DOUBLE) AS quantidade_ajuste FROM g"""

SQL_FUTURES_CONTRACTS = f"""{_SQL_FUTURES}
SELECT ticker, 'BR' || ticker AS codigo_isin, venc AS data_vencimento FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY d DESC) AS r FROM g) WHERE r = 1"""


def auctions(spark, sf):
    """S16 + T6 + M6: yearly responses with a ``registros`` list (here two records per order:
    the auction and its second round) → one row per record → typed → keyed."""
    o = table(spark, sf, "orders")
    d = _d("o_orderdate")

    def rec(day, edital):
        return F.struct(F.date_format(day, "yyyy-MM-dd").alias("data_leilao"), F.col("o_orderstatus").alias("titulo"),
                        F.date_format(F.last_day(d), "yyyy-MM-dd").alias("vencimento"),
                        edital.cast("string").alias("numero_edital"), F.col("o_orderkey").cast("string").alias("oferta"),
                        F.col("o_totalprice").cast("string").alias("pu_medio"))

    responses = o.select(F.col("o_orderkey").alias("_resp"),
                         F.array(rec(d, F.col("o_custkey") % 500), rec(F.date_add(d, 7), F.col("o_custkey") % 500 + 1000))
                         .alias("registros"))
    rows = landing_mod.auction_records(responses)
    typed = silver.leiloes(rows).withColumn("_seq", F.struct("_resp", "_rpos"))
    return materialize(typed, "leiloes", "*", ["_seq"])


SQL_AUCTIONS = """
WITH r AS (
  SELECT o_orderkey AS resp, 0 AS pos, CAST(o_orderdate AS DATE) AS data_referencia, o_orderstatus AS tipo_titulo,
         last_day(CAST(o_orderdate AS DATE)) AS data_vencimento, o_custkey % 500 AS numero_edital,
         o_orderkey AS oferta, o_totalprice AS pu_medio FROM orders
  UNION ALL
  SELECT o_orderkey, 1, CAST(CAST(o_orderdate AS DATE) + 7 AS DATE), o_orderstatus, last_day(CAST(o_orderdate AS DATE)),
         o_custkey % 500 + 1000, o_orderkey, o_totalprice FROM orders)
SELECT CAST(numero_edital AS BIGINT) AS numero_edital, tipo_titulo, data_vencimento, data_referencia,
       CAST(oferta AS BIGINT) AS oferta, CAST(NULL AS DOUBLE) AS quantidade_aceita, CAST(NULL AS DOUBLE) AS percentual_corte,
       CAST(NULL AS DOUBLE) AS oferta_segunda_volta, CAST(NULL AS DOUBLE) AS financeiro_aceito,
       CAST(NULL AS DOUBLE) AS financeiro_aceito_segunda_volta, CAST(NULL AS DOUBLE) AS quantidade_aceita_segunda_volta,
       pu_medio, CAST(NULL AS DOUBLE) AS taxa_media
FROM (SELECT *, row_number() OVER (PARTITION BY tipo_titulo, data_vencimento, data_referencia, numero_edital
                                   ORDER BY resp, pos) AS rn FROM r) WHERE rn = 1"""


def gap_summary_q(spark, sf):
    from cupom.plans.incremental import gap_summary

    return gap_summary(gap_report(spark, sf), "bronze")


SQL_GAP_SUMMARY = f"""SELECT 'bronze' AS layer, dataset, CAST(count(*) AS BIGINT) AS n_missing,
  min(value) AS first_missing, max(value) AS last_missing FROM ({SQL_GAPS}) GROUP BY dataset"""


def projection_refresh(spark, sf):
    """Expected months = months of the orders range; present = months by their order count;
    active = neighbours of the last order date."""
    from cupom.plans.incremental import projection_refresh_months

    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    bounds = o.agg(F.trunc(F.min(d), "MM").alias("lo"), F.trunc(F.max(d), "MM").alias("hi"))
    expected = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    present = o.groupBy(F.trunc(d, "MM").alias("m")).agg(F.sum("o_custkey").alias("n")).where("n % 3 <> 0")
    last = o.agg(F.max(d)).first()[0]
    return projection_refresh_months(expected, present, last)


SQL_PROJECTION_REFRESH = """
WITH b AS (SELECT CAST(date_trunc('month', min(CAST(o_orderdate AS DATE))) AS DATE) AS lo,
                  CAST(date_trunc('month', max(CAST(o_orderdate AS DATE))) AS DATE) AS hi,
                  max(CAST(o_orderdate AS DATE)) AS last FROM orders),
exp AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS value FROM b),
have AS (SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS value FROM orders
         GROUP BY 1 HAVING sum(o_custkey) % 3 <> 0)
SELECT value FROM exp WHERE value NOT IN (SELECT value FROM have)
UNION
SELECT CAST(date_trunc('month', last) + INTERVAL (k) MONTH AS DATE) FROM b, (VALUES (-1), (0), (1)) t(k)"""


def lake_quotes(spark, sf):
    """``update()`` end to end on the test tables: one quote per bond and day rendered from lineitem
    lands as JSON in a fresh lake under the shared checkpoint folder; landing → bronze (daily
    partitions) → silver (T3) → gold (M4 + bond dimension, W9/W7); the gold quotes are returned."""
    from cupom.plans.update import update
    from cupom.session import scratch_path
    from cupom.sinks.tables import read_table

    li = table(spark, sf, "lineitem")
    d = _d("l_shipdate")
    per_key = li.groupBy(F.col("l_linestatus").alias("tipo_titulo"), F.last_day(d).alias("venc"),
                         d.alias("dia")).agg(F.max("l_discount").alias("taxa"), F.max("l_extendedprice").alias("pu"),
                                             F.min("l_tax").alias("lo"), F.max("l_tax").alias("hi"))
    landed = per_key.select("tipo_titulo", F.col("venc").cast("string").alias("data_vencimento"),
                            F.col("dia").cast("string").alias("data_referencia"),
                            F.col("taxa").cast("string").alias("taxa_indicativa"),
                            F.col("lo").alias("intervalo_min_d0"), F.col("hi").alias("intervalo_max_d0"),
                            F.col("lo").alias("intervalo_min_d1"), F.col("hi").alias("intervalo_max_d1"), "pu")
    root = scratch_path(spark, "lake")
    landed.write.json(f"{root}/landing/mercado_secundario")
    lo, hi = per_key.agg(F.min("dia"), F.max("dia")).first()
    report = update(spark, root, datasets=["mercado_secundario"], start_date=lo, end_date=hi, data_start="1900-01-01", gap_gate=False)
    errors = [(r.layer, r.detail) for r in report.where("status = 'error'").collect()]
    if errors:
        raise RuntimeError(f"update failed: {errors}")
    return read_table(spark, root, "MERCADO_SECUNDARIO").drop("p_month")


SQL_LAKE_QUOTES = """
SELECT l_linestatus AS tipo_titulo, last_day(CAST(l_shipdate AS DATE)) AS data_vencimento,
       CAST(l_shipdate AS DATE) AS data_referencia, max(l_discount) AS taxa_anbima, min(l_tax) AS intervalo_min_d0,
       max(l_tax) AS intervalo_max_d0, min(l_tax) AS intervalo_min_d1, max(l_tax) AS intervalo_max_d1,
       max(l_extendedprice) AS pu, CAST(NULL AS VARCHAR) AS expressao, CAST(NULL AS DATE) AS data_base,
       CAST(NULL AS VARCHAR) AS codigo_selic, CAST(NULL AS VARCHAR) AS codigo_isin, CAST(NULL AS DOUBLE) AS taxa_compra,
       CAST(NULL AS DOUBLE) AS taxa_venda, CAST(NULL AS DOUBLE) AS desvio_padrao, 'ATIVO' AS status
FROM lineitem GROUP BY 1, 2, 3"""


def date_keys(spark, sf):
    """C15–C19 over every order: alias-field pick, month key, yyyyMM text, (year, month) → first day,
    and ISO / dd/MM/yyyy / yyyyMMdd text → dd/MM/yyyy."""
    from cupom.functions.coerce import first_of_month, first_present, month_start, to_ddmmyyyy, yyyymm_text

    o = table(spark, sf, "orders")
    d = _d("o_orderdate")
    k = F.col("o_orderkey") % 3
    text = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd/MM/yyyy"))
            .otherwise(F.date_format(d, "yyyyMMdd")))
    blank_alias = F.when(F.col("o_orderkey") % 2 == 0, F.lit(" ")).otherwise(F.lit(None).cast("string"))
    x = o.select("o_orderkey", d.alias("d"), text.alias("raw_text"), blank_alias.alias("alias_a"))
    return x.select("o_orderkey", first_present("alias_a", F.col("d").cast("string")).alias("picked"),
                    month_start("d").alias("month_key"), yyyymm_text("d").alias("yyyymm"),
                    first_of_month(F.year("d"), F.month("d")).alias("first_day"),
                    to_ddmmyyyy("raw_text").alias("ddmmyyyy"))


SQL_DATE_KEYS = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS picked,
       CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month_key,
       strftime(CAST(o_orderdate AS DATE), '%Y%m') AS yyyymm,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS first_day,
       strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS ddmmyyyy
FROM orders"""


# ------------------------------------------------------------------------------------ registry

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {
    "series_all": (lambda s, sf: _series(s, sf).fetch_all(), SQL_SERIES),
    "series_latest": (lambda s, sf: _series(s, sf).fetch_latest(LATEST_N),
                      f"WITH s AS ({SQL_SERIES}), d AS (SELECT data_referencia FROM s GROUP BY 1 "
                      f"ORDER BY 1 DESC LIMIT {LATEST_N}) SELECT * FROM s WHERE data_referencia IN "
                      f"(SELECT data_referencia FROM d)"),
    "series_on": (lambda s, sf: _series(s, sf).fetch_on(ON_DATE),
                  f"{SQL_SERIES} WHERE CAST(o_orderdate AS DATE) = DATE '{ON_DATE}'"),
    "series_range": (lambda s, sf: _series(s, sf).fetch_range(*RANGE),
                     f"{SQL_SERIES} WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"),
    "quotes_settlements_all": (lambda s, sf: _combined(s, sf).fetch_all(), _sql_combined()),
    "quotes_settlements_latest": (lambda s, sf: _combined(s, sf).fetch_latest(LATEST_N_COMBINED),
                                  _sql_combined(_IN_LATEST, _IN_LATEST, _LATEST_COMBINED_CTE)),
    "quotes_settlements_on": (lambda s, sf: _combined(s, sf).fetch_on(ON_DATE),
                              _sql_combined(f"WHERE data_referencia = DATE '{ON_DATE}'",
                                            f"WHERE data_referencia = DATE '{ON_DATE}'")),
    "quotes_settlements_range": (lambda s, sf: _combined(s, sf).fetch_range(*RANGE),
                                 _sql_combined(f"WHERE data_referencia BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
                                               f"WHERE data_referencia BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'")),
    "dedup_first": (dedup_first, _sql_dedup(False)),
    "dedup_last": (dedup_last, _sql_dedup(True)),
    "numeric_coerce": (numeric_coerce, SQL_NUMERIC),
    "date_coerce": (date_coerce, SQL_DATE),
    "month_coerce": (month_coerce, SQL_MONTH),
    "slash_disambiguate": (slash_disambiguate, SQL_SLASH),
    "column_decimal_flag": (column_decimal_flag, SQL_DECIMAL),
    "ptax_parse": (ptax_parse, SQL_PTAX),
    "dup_keys": (dup_keys, SQL_DUP_KEYS),
    "pivot_long": (pivot_monthly, SQL_PIVOT),
    "month_to_business_day": (month_to_business_day, SQL_MONTH_DAILY),
    "explode_titles": (explode_titles, SQL_EXPLODE),
    "newest_file": (newest_file, SQL_NEWEST),
    "business_day_shift": (business_day_shift, SQL_BDAY_SHIFT),
    "month_15th": (month_15th, SQL_MONTH_15TH),
    "ipca_daily": (ipca_daily, SQL_IPCA),
    "upsert_merge": (upsert_merge, SQL_UPSERT),
    "snapshot_replace": (snapshot_replace, SQL_SNAPSHOT),
    "dim_replace": (dim_replace, SQL_DIM_REPLACE),
    "dim_coalesce": (dim_coalesce, SQL_DIM_COALESCE),
    "merge_revisions": (merge_revisions_q, SQL_REVISIONS),
    "coverage_check": (coverage_check, SQL_COVERAGE),
    "gap_report": (gap_report, SQL_GAPS),
    "stale_partitions": (stale_partitions_q, SQL_STALE),
    "refresh_scope": (refresh_scope_q, SQL_REFRESH),
    "gold_delete": (gold_delete, SQL_GOLD_DELETE),
    "constraint_violations": (constraints_q, SQL_CONSTRAINTS),
    "time_series": (time_series, SQL_TIME_SERIES),
    "ipca_silver": (ipca_silver, SQL_IPCA_SILVER),
    "futures_adjustments": (futures_adjustments, SQL_FUTURES_ADJ),
    "futures_contracts": (futures_contracts, SQL_FUTURES_CONTRACTS),
    "auctions": (auctions, SQL_AUCTIONS),
    "gap_summary": (gap_summary_q, SQL_GAP_SUMMARY),
    "projection_refresh": (projection_refresh, SQL_PROJECTION_REFRESH),
    "lake_quotes": (lake_quotes, SQL_LAKE_QUOTES),
    "date_keys": (date_keys, SQL_DATE_KEYS),
}
