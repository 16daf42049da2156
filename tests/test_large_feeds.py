"""Feeds as they get with many bonds: years past 9999, documents of bounded length, a broken line before many good ones."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from cupom.functions.coerce import to_date_any
from cupom.plans import feeddata, silver
from cupom.plans.reader import read_data
from cupom.session import conf_override
from cupom.sources import json_values
from cupom.streaming.ingest import run_available_now


@pytest.mark.parametrize(("text", "want"), [("+16541-04-26", "+16541-04-26"), ("26/04/+16541", "+16541-04-26"), ("04/26/+16541", "+16541-04-26"),
                                            ("+16541-04-26T00:00", "+16541-04-26"), ("2030-04-26", "2030-04-26"), ("26/04/2030", "2030-04-26"),
                                            ("+16541-13-26", None), ("+5", None), ("x/+y", None), ("16541-04-26", None), ("26/04/203012", None), (None, None)])
def test_dates_past_9999_have_a_sign(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(to_date_any("t").cast("string").alias("d")).first().d
    assert got == want


def test_feeds_keep_due_dates_past_9999(spark):
    due = F.expr("date_add(DATE '2030-01-01', 5300000)")
    row = spark.range(1).select(F.lit("LTN").alias("tipo_titulo"), F.lit("LTN").alias("titulo"), F.lit("2026-01-05").alias("data_referencia"), due.cast("string").alias("data_vencimento"))
    assert silver.mercado_secundario(row).where(F.col("data_vencimento") == due).count() == 1
    assert silver.leiloes(row).where(F.col("data_vencimento") == due).count() == 1
    settled = spark.range(1).select(F.lit("05/01/2026").alias("DATA MOV"), F.date_format(due, "dd/MM/yyyy").alias("VENCIMENTO"))
    assert silver.liquidacoes_mercado(settled).where((F.col("data_vencimento") == due) & (F.col("data_referencia") == F.lit(dt.date(2026, 1, 5)))).count() == 1


BROKEN = '{"a": 0, "tr\n' + "".join('{"a": %d, "b": "}"}\n' % n for n in range(1, 40)) + '{\n  "a": 40\n}\n[\n{"a": 41},\n{"a": 42}\n]\n'


@pytest.mark.parametrize("split", ["128m", "50b"])  # one block, and many
def test_a_broken_line_does_not_take_its_file_along(spark, tmp_path, split):
    (tmp_path / "a.json").write_text(BROKEN)
    with conf_override(spark, {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}):
        values = json_values._joined(json_values._parts(spark, [str(tmp_path / "a.json")])).collect()
        assert max(len(r.value.split("\n")) for r in values) <= 4
        rows = json_values.json_records(spark, [str(tmp_path / "a.json")]).collect()
    assert sorted(int(r.a) for r in rows if r.a) == list(range(1, 43))
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ['{"a": 0, "tr']


def test_a_replay_of_quotes_keeps_the_newest(spark, tmp_path):
    land = tmp_path / "landing" / "mercado_secundario"
    land.mkdir(parents=True)
    for n, (name, rate) in enumerate((("b", "1"), ("a", "2"), ("c", "3"))):
        row = {"tipo_titulo": "LTN", "data_vencimento": "2030-01-01", "data_referencia": "2026-01-15", "taxa_indicativa": rate, "pu": "1"} | {f"intervalo_{x}": "1" for x in ("min_d0", "max_d0", "min_d1", "max_d1")}
        (land / f"{name}.json").write_text(json.dumps([row, row | {"taxa_indicativa": "9"}]))
        os.utime(land / f"{name}.json", (1000 + n, 1000 + n))
    run_available_now(spark, str(tmp_path), "mercado_secundario", str(tmp_path / "point"))
    assert [r.taxa_anbima for r in read_data(spark, str(tmp_path)).mercado_secundario.fetch_all().collect()] == [3.0]  # first row of the newest file


def test_stream_rounds_takes_every_order(spark, tmp_path):
    rows = [(k, 7 + k % 2, "FOP"[k % 3], float(k), dt.datetime(1998, 1, 1 + k % 8)) for k in range(1, 25)] + [(99, 5_300_000, "O", 5.0, dt.datetime(1998, 1, 5))]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    out = feeddata.stream_rounds(spark, str(tmp_path)).select("feed", "key", F.col("due").cast("string"), F.col("day").cast("string"), "x", "more").collect()
    due = lambda cust: F.expr(f"date_add(DATE '2030-01-01', {cust})").cast("string")
    (one, two, far), = spark.range(1).select(due(7), due(8), due(5_300_000)).collect()
    want, day = {}, lambda d: str(feeddata.FIRST_DAY + dt.timedelta((d % 40) // 5 * 7 + d % 5))
    for _, cust, kind, price, at in rows:
        key = (kind, cust, at.timetuple().tm_yday)
        want[key] = max(price, want.get(key, 0))
    dues = {7: one, 8: two, 5_300_000: far}
    quotes = [("quotes", kind, dues[cust], day(d), p * (2 if d % 3 == 1 else 1), "later" if d % 3 == 1 else None) for (kind, cust, d), p in want.items()]
    auctions = [("auctions", str(cust), dues[cust], day(d), p, None) for (kind, cust, d), p in want.items()]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [*quotes, *auctions, ("aside", None, None, None, None, '{"tipo_titulo": "broken')]))


@pytest.mark.parametrize("keys", [(), ("kind",)])
def test_documents_are_paged(spark, keys):
    rows = spark.range(1000).select(F.lit(dt.date(1998, 1, 5)).alias("day"), F.lit("O").alias("kind"), F.when(F.col("id") > 0, F.col("id") * 3).alias("cust"))
    got = feeddata._paged(rows, F.struct("cust"), "list", *keys).select(F.size("list").alias("n")).collect()
    assert max(r.n for r in got) <= feeddata.PAGE and sum(r.n for r in got) == 1000


def test_landed_documents_do_not_grow_with_their_day(spark, tmp_path):
    facts = spark.range(250).select(F.lit("O").alias("kind"), F.col("id").alias("cust"), F.lit(0).alias("k"), F.lit(1).alias("n"), F.lit(2.0).alias("price"), F.lit(dt.date(1998, 1, 5)).alias("day"), F.lit(dt.date(2030, 1, 1)).alias("due"))
    feeddata._land_batch(spark, facts, str(tmp_path), "a")
    for feed, name in (("vna", "titulos"), ("leiloes", "registros")):
        sizes = [len(json.loads(r.value)[name]) for r in spark.read.text(f"{tmp_path}/{feed}/a").collect()]
        assert sum(sizes) == 250 and max(sizes) <= feeddata.PAGE
