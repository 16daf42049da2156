"""What grows with the data: roots of many records, files of many rows, and work that was done more than once."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from cupom.plans import feeddata, silver, testdata
from cupom.sinks import tables
from cupom.sources import feeds, json_values
from cupom.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def above_generate(df):
    text = plan(df)
    return text[: text.rindex("Generate ")]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_a_title_does_not_carry_its_day_record(spark):
    day = spark.createDataFrame([(1, {"Data": "2026-01-05", "titulos": '[{"codigoSelic": "1", "VNA": "2"}, {"codigo": "3", "data": "2026-01-06"}]'}),
                                 (2, {"codigo": "5", "valor": "6"}), (3, {"Data": "2026-01-07"})], "_seq int, rec map<string,string>")
    rows = silver.vna_records(day.where("_seq > 0"), "rec")
    assert "rec#" not in above_generate(rows)
    got = sorted((r._seq, r._pos, r.data_referencia, r.codigo_selic, r.vna) for r in rows.collect())
    assert got == [(1, 0, "2026-01-05", "1", "2"), (1, 1, "2026-01-06", "3", None), (2, 0, None, "5", "6")]


def test_records_are_parsed_once_and_do_not_carry_their_list(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"ano": 1, "registros": [{"n": 1}, {"n": 2}]}\n{"ano": 2, "registros": []}\n[{"ano": 3}, null]\n{"ano": \n')
    rows = json_values.json_records(spark, [path], "registros")
    got = sorted((r.ano, r.n, r._corrupt_record) for r in rows.select(*[F.coalesce(c, F.lit("-")).alias(c) for c in ("ano", "n", "_corrupt_record")]).collect())
    assert [g[:2] for g in got if g[2] == "-"] == [("1", "1"), ("1", "2"), ("3", "-")]
    assert '[{"ano": 3}, null]' in [g[2] for g in got]
    assert plan(rows).count("from_json(") <= 1


@pytest.mark.parametrize("line", ['{"a": "x"}', '{"a": "}{"}', '{"a": "b}', '{"a": 1} {"b": 2}', '{"a": [1]}', '{"a": "\\"}"}', ' {"a": {"b": "]"}} ', '{"a": 1}}', "x"])
def test_steps_of_a_line(spark, tmp_path, line):
    """The quick way for flat records gives what counting outside of strings gives."""
    got = json_values._parts(spark, [write(tmp_path / "a.json", line + "\n")]).collect()
    for r in got:
        bare = re.sub(r'"[^"\\]*(?:\\.[^"\\]*)*"', "", r.text)
        assert r.step == sum(bare.count(c) for c in "{[") - sum(bare.count(c) for c in "}]")
    assert len(got) == (2 if line.count('": ') == 2 and "} {" in line else 1)


def test_ragged_files_are_joined_once(spark, tmp_path):
    path = write(tmp_path / "a.json", '{\n "a": 1\n}\n{"a": 2}\n')
    values, _ = json_values.split_values(spark, [path])
    assert "Window" not in plan(values)
    assert sorted(r.value for r in values.collect()) == ['{\n "a": 1\n}', '{"a": 2}']


def test_futures_files_are_read_twice_at_most(spark, tmp_path):
    head = "RptDt;TckrSymb;AdjstdQt\n"
    a = write(tmp_path / "a.csv", head + "2026-01-05;DI1F1;1\n2026-01-05;DI1F2;2\n2026-01-06;DI1F1;3\nx;DI1F1;4\n")
    b = write(tmp_path / "b.csv", head + "2026-01-05;DI1F1;5\n")
    c = write(tmp_path / "pr20260107.csv", "TckrSymb;AdjstdQt\nDI1F1;6\n")
    os.utime(a, (1, 1))
    df = feeds.read_landed(spark, str(tmp_path), "ajustes_bmf", None, [a, b, c])
    assert plan(df).count("Relation [RptDt") <= 2
    got = sorted((str(r._src), r.AdjstdQt) for r in df.collect())
    assert got == [("2026-01-05", "5"), ("2026-01-06", "3"), ("2026-01-07", "6"), ("None", "4")]


def orders(spark, tmp_path):
    rows = [(k, 7, "F", float(k), dt.datetime(1998, 1, k)) for k in range(1, 9)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_facts_are_summed_once(spark, tmp_path):
    facts = feeddata._facts(spark, orders(spark, tmp_path))
    assert "Aggregate" not in plan(facts)
    assert facts.count() == 8 and facts.where("day is null or due is null").isEmpty()


def test_a_stream_batch_is_computed_once(spark, tmp_path, monkeypatch):
    write(tmp_path / "landing" / "cdi" / "a.json", '{"data_referencia": "05/01/2026", "estimativa_taxa_selic": 1.5}\n')
    kept, own = [], tables.persist
    monkeypatch.setattr(tables, "persist", lambda spark, root, builder, result, *a, **k: (kept.append(result.storageLevel.useMemory), own(spark, root, builder, result, *a, **k)))
    ingest.run_available_now(spark, str(tmp_path), "cdi", str(tmp_path / "point"))
    assert kept == [True]
    assert [r.cdi for r in tables.read_table(spark, str(tmp_path), "CDI").collect()] == [1.5]


def test_titles_are_ranked_by_a_short_order(spark, tmp_path):
    day = dt.datetime(1998, 1, 5)
    rows = [(1, 1, 1, 9, float(q), 10.0 * q, 0.1, 0.2, "A", "O", day) for q in (3, 1, 2)] + [(None, None, 1, 9, 7.0, 1.0, 0.1, 0.2, "A", "O", day)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = testdata.explode_titles(spark, str(tmp_path))
    top = plan(out)
    top = top[: top.index("Generate ")]
    assert "l_quantity" not in top
    assert sorted((r.codigo_selic, r.vna) for r in out.collect()) == [(1, 30.0), (9, 3.0), (9, 7.0)]
