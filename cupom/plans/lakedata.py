"""Driver queries that run the pipeline itself: a fresh lake under the shared folder, landed files rendered from the test
tables, ``update()`` one or more times, and what it left in gold or quarantine.

Quotes are rendered per order status and month of ``orders`` (every row counts), dated on the month's last day, so a
lake has one partition per month of the table's range. Each query has an independently written DuckDB statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cupom.functions import calendar as cal
from cupom.plans import silver
from cupom.plans.gold import ALL_DATES, materialize
from cupom.plans.incremental import inflation_buildable_days
from cupom.plans.update import result_summary, sync_status, update
from cupom.session import scratch_path
from cupom.sinks import tables
from cupom.sources import landing

DATASET = "mercado_secundario"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").withColumn("d", F.col("o_orderdate").cast("date"))


def _quotes(spark: SparkSession, sf: str) -> DataFrame:
    """One quote per status and month, with the sum of its customers for rules that pick some."""
    return _orders(spark, sf).groupBy(F.col("o_orderstatus").alias("tipo_titulo"), F.last_day("d").alias("day")).agg(
        F.max("o_totalprice").alias("pu"), F.min("o_totalprice").alias("low"), F.sum("o_custkey").alias("n"))


def _land(quotes: DataFrame, root: str, name: str, date: Column, pu: Column | None = None) -> None:
    """Write quotes as landed JSON files in a folder of their own."""
    text = lambda c: c.cast("string")
    rows = quotes.select("tipo_titulo", text(F.col("day")).alias("data_vencimento"), text(date).alias("data_referencia"),
                         F.col("low").alias("taxa_indicativa"), *[F.lit(i).alias(c) for i, c in enumerate(
                             ("intervalo_min_d0", "intervalo_max_d0", "intervalo_min_d1", "intervalo_max_d1"))],
                         (pu if pu is not None else F.col("pu")).alias("pu"), F.lit("--").alias("desvio_padrao"))
    rows.write.mode("overwrite").json(f"{root}/landing/{DATASET}/{name}")


def _update(spark: SparkSession, root: str, lo, hi, **more) -> None:
    report = update(spark, root, datasets=[DATASET], start_date=lo, end_date=hi, data_start="1900-01-01", gap_gate=False, **more)
    errors = [(r.layer, r.detail) for r in report.where("status = 'error'").collect()]
    if errors:
        raise RuntimeError(f"update failed: {errors}")


def _window(quotes: DataFrame):
    return quotes.agg(F.min("day"), F.max("day")).first()


def lake_rejects(spark, sf):
    """Quotes with unreadable dates go to quarantine; accepted and rejected per bond month."""
    quotes, root = _quotes(spark, sf), scratch_path(spark, "lake-rejects")
    _land(quotes, root, "all", F.when(F.col("n") % 3 == 0, "no date").otherwise(F.col("day").cast("string")))
    _update(spark, root, *_window(quotes))
    accepted = tables.read_table(spark, root, DATASET).select(F.col("data_vencimento").alias("day"), F.lit(1).alias("accepted"), F.lit(0).alias("rejected"))
    rejected = spark.read.schema("data_vencimento string").option("recursiveFileLookup", True).parquet(f"{root}/quarantine/{DATASET}")
    rejected = rejected.select(F.col("data_vencimento").cast("date").alias("day"), F.lit(0).alias("accepted"), F.lit(1).alias("rejected"))
    return accepted.unionByName(rejected).groupBy("day").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


_SQL_QUOTES = """q AS (SELECT o_orderstatus AS tipo_titulo, last_day(CAST(o_orderdate AS DATE)) AS day, max(o_totalprice) AS pu,
  min(o_totalprice) AS low, sum(o_custkey) AS n FROM orders GROUP BY ALL)"""

SQL_REJECTS = f"""WITH {_SQL_QUOTES}
SELECT day, count(*) FILTER (n % 3 <> 0) AS accepted, count(*) FILTER (n % 3 = 0) AS rejected FROM q GROUP BY day"""


def lake_batches(spark, sf):
    """Two landed batches, each followed by a run; the second reads new files and pending days alone."""
    quotes, root = _quotes(spark, sf), scratch_path(spark, "lake-batches")
    lo, hi = _window(quotes)
    for name, rows in (("first", quotes.where("month(day) % 2 = 1")), ("second", quotes.where("month(day) % 2 = 0"))):
        _land(rows, root, name, F.col("day"))
        _update(spark, root, lo, hi)
    return tables.read_table(spark, root, DATASET).select("tipo_titulo", "data_vencimento", "data_referencia", "taxa_anbima", "pu", "desvio_padrao", "status")


SQL_BATCHES = f"""WITH {_SQL_QUOTES}
SELECT tipo_titulo, day AS data_vencimento, day AS data_referencia, low AS taxa_anbima, pu, CAST(NULL AS DOUBLE) AS desvio_padrao, 'ATIVO' AS status FROM q"""


def force_refresh(spark, sf):
    """V1-V6: corrected files change nothing until the days are refreshed by force, on a URI root; other days stay."""
    quotes, root = _quotes(spark, sf), scratch_path(spark, "lake-force")
    root = root if ":" in root else f"file://{root}"
    lo, hi = _window(quotes)
    _land(quotes, root, "all", F.col("day"))
    _update(spark, root, lo, hi)
    _land(quotes, root, "all", F.col("day"), F.col("pu") * 2)
    _update(spark, root, lo, hi)
    days = [r.day for r in quotes.groupBy("day").agg(F.sum("n").alias("n")).where("n % 4 <> 1").collect()]  # a row per month
    _update(spark, root, lo, hi, force=True, refresh_dates=days)
    return tables.read_table(spark, root, DATASET).select("tipo_titulo", "data_referencia", "pu")


SQL_FORCE = f"""WITH {_SQL_QUOTES}
SELECT tipo_titulo, day AS data_referencia, CASE WHEN sum(n) OVER (PARTITION BY day) % 4 <> 1 THEN pu * 2 ELSE pu END AS pu FROM q"""


def sync_gaps(spark, sf):
    """Gaps of all layers after bronze and silver alone have run: weekdays without quotes, and gold days."""
    quotes, root = _quotes(spark, sf), scratch_path(spark, "lake-gaps")
    lo, hi = _window(quotes)
    _land(quotes, root, "all", F.col("day"))
    _update(spark, root, lo, hi, layers=("bronze", "silver"))
    return sync_status(spark, root, lo, hi, [DATASET], "1900-01-01")


SQL_SYNC_GAPS = f"""WITH {_SQL_QUOTES}, b AS (SELECT min(day) AS lo, max(day) AS hi FROM q),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT 'bronze' AS layer, 'mercado_secundario' AS dataset, CAST(d AS VARCHAR) AS value FROM days
WHERE isodow(d) < 6 AND d NOT IN (SELECT day FROM q)
UNION ALL SELECT DISTINCT 'gold', 'mercado_secundario', CAST(day AS VARCHAR) FROM q"""


def ipca_buildable(spark, sf):
    """I4: days of the orders' range that have projections and an index history without holes."""
    o = _orders(spark, sf)
    months = o.groupBy(F.trunc("d", "MM").alias("m")).agg(F.sum("o_custkey").alias("n"))
    bounds = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = cal.days_between(bounds, "lo", "hi", "d").select("d")
    first = o.agg(F.trunc(F.min("d"), "MM")).first()[0]
    return inflation_buildable_days(days, months.where("n % 11 <> 3").select("m"), months.where("n % 5 <> 2").select("m"), first)


SQL_IPCA_BUILDABLE = """WITH m AS (SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS m, sum(o_custkey) AS n FROM orders GROUP BY 1),
b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
span AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m FROM b)
SELECT d FROM days WHERE date_trunc('month', d) IN (SELECT m FROM m WHERE n % 5 <> 2)
  AND NOT EXISTS (SELECT 1 FROM span WHERE span.m < date_trunc('month', days.d) AND span.m NOT IN (SELECT m FROM m WHERE n % 11 <> 3))"""


# ---------------------------------------------------------------- feeds that no other query runs


def cdi_gold(spark, sf):
    """A Selic-estimate payload per event, first of each day."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    records = ev.select(F.date_format("ts", "dd/MM/yyyy").alias("data_referencia"), F.col("value").cast("string").alias("estimativa_taxa_selic"), F.col("event_id").alias("_seq"))
    return materialize(silver.cdi(landing.selic_estimate_records(records, ("_seq",))), "cdi", ALL_DATES)


SQL_CDI = """SELECT CAST(ts AS DATE) AS data_referencia, arg_min(value, event_id) AS cdi FROM events GROUP BY 1"""


def settlements_silver(spark, sf):
    """T4, M5: settlement rows with the feed's headers and comma decimals."""
    o = _orders(spark, sf)
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    raw = o.select(F.date_format("d", "dd/MM/yyyy").alias("DATA MOV"), F.col("o_orderstatus").alias("SIGLA"), F.date_format(F.last_day("d"), "dd/MM/yyyy").alias("VENCIMENTO"),
                   F.col("o_custkey").cast("string").alias("NUM DE OPER"), comma(F.col("o_totalprice").cast("decimal(18,2)")).alias("QUANT NEGOCIADA"),
                   F.lit("no price").alias("PU MED"), "o_orderkey")
    return silver.liquidacoes_mercado(raw).select("o_orderkey", "data_referencia", "tipo_titulo", "data_vencimento", "qtd_operacoes", "qtd_titulos", "pu_medio")


SQL_SETTLEMENTS_SILVER = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data_referencia, o_orderstatus AS tipo_titulo, last_day(CAST(o_orderdate AS DATE)) AS data_vencimento,
  CAST(o_custkey AS DOUBLE) AS qtd_operacoes, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS qtd_titulos, CAST(NULL AS DOUBLE) AS pu_medio FROM orders"""


def projections_silver(spark, sf):
    """Every revision stays, months and dates in several shapes."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    raw = ev.select(F.concat(F.lit(" "), "event_type").alias("indice"), F.lit("atual ").alias("tipo_projecao"), F.date_format("ts", "dd/MM/yyyy").alias("data_coleta"),
                    F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "MM/yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("mes_referencia"),
                    F.col("value").cast("string").alias("variacao_projetada"), F.lit("").alias("data_validade"), F.col("event_id").alias("_seq"))
    return silver.projecoes(raw).withColumnRenamed("_seq", "event_id")


SQL_PROJECTIONS = """SELECT event_type AS indice, 'atual' AS tipo_projecao, CAST(ts AS DATE) AS data_coleta, CAST(date_trunc('month', ts) AS DATE) AS ref_month,
  value AS variacao_projetada, CAST(NULL AS DATE) AS data_validade, event_id FROM events"""


def month_windows(spark, sf):
    """K3, K8: months of the orders' range, each with the window of at most two years that it begins in."""
    lo, hi = _orders(spark, sf).agg(F.min("d"), F.max("d")).first()
    months = cal.months_in_range(spark, lo, hi, "month")
    return months.join(cal.split_windows(spark, lo, hi, 2), F.greatest(F.col("month"), F.lit(lo)).between(F.col("win_start"), F.col("win_end")))


SQL_MONTH_WINDOWS = """WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS month, lo, hi FROM b),
w AS (SELECT CAST(lo + INTERVAL (2 * k) YEAR AS DATE) AS win_start, least(hi, CAST(lo + INTERVAL (2 * k + 2) YEAR - INTERVAL 1 DAY AS DATE)) AS win_end
      FROM b, range(50) AS r(k) WHERE lo + INTERVAL (2 * k) YEAR <= hi)
SELECT month, win_start, win_end FROM m JOIN w ON greatest(month, lo) BETWEEN win_start AND win_end"""


def series_summary(spark, sf):
    """Rows and first and last date, of quotes by status."""
    return result_summary(_orders(spark, sf), "d")


SQL_SUMMARY = """SELECT count(*) AS rows, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders"""

REGISTRY = {
    "lake_rejects": (lake_rejects, SQL_REJECTS),
    "lake_batches": (lake_batches, SQL_BATCHES),
    "force_refresh": (force_refresh, SQL_FORCE),
    "sync_gaps": (sync_gaps, SQL_SYNC_GAPS),
    "ipca_buildable": (ipca_buildable, SQL_IPCA_BUILDABLE),
    "cdi_gold": (cdi_gold, SQL_CDI),
    "settlements_silver": (settlements_silver, SQL_SETTLEMENTS_SILVER),
    "projections_silver": (projections_silver, SQL_PROJECTIONS),
    "month_windows": (month_windows, SQL_MONTH_WINDOWS),
    "series_summary": (series_summary, SQL_SUMMARY),
}
