"""Files of one run that differ in layout: column orders, later columns, JSON in any shape, zipped tables, inflation layouts."""

import datetime as dt
import io
import json
import os
import zipfile

import pandas as pd
import pytest

from cupom.plans.reader import read_data
from cupom.plans.update import update
from cupom.sources import json_values, landing, registry, tabular

D = dt.date


def land(root, dataset, name, content):
    path = root / "landing" / dataset / name
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, pd.DataFrame):
        content.to_parquet(path, index=False)
    else:
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def run(spark, root, dataset, lo="2026-01-01", hi="2026-01-31", **more):
    report = update(spark, str(root), datasets=dataset if isinstance(dataset, list) else [dataset], start_date=lo, end_date=hi, gap_gate=False, **more).collect()
    assert not [r for r in report if r.status == "error"], report
    return {(r.layer, r.name): r for r in report}


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "."), text.encode("latin-1"))
    return out.getvalue()


HEAD = "DATA MOV;SIGLA;VENCIMENTO;NUM DE OPER;QUANT NEGOCIADA;PU MED\n"
SWAPPED = "SIGLA;DATA MOV;VENCIMENTO;NUM DE OPER;PU MED;QUANT NEGOCIADA;CODIGO\n"


def settlements(spark, root):
    return sorted((str(r.data_referencia), r.tipo_titulo, r.qtd_operacoes, r.qtd_titulos, r.pu_medio) for r in read_data(spark, str(root)).liquidacoes_mercado.fetch_all().collect())


def test_settlements_meet_by_name(spark, tmp_path):
    land(tmp_path, "liquidacoes_mercado", "a.csv", HEAD + "14/01/2026;LTN;01/01/2030;5;10,5;1000,5\n")
    land(tmp_path, "liquidacoes_mercado", "b c.csv", SWAPPED + "LTN;15/01/2026;01/01/2030;6;900,5;10;X\nLTN;15/01/2026;01/01/2031;6;900,5;10;X;too;many\nLFT;15/01/2026;01/01/2032;1;2\n")
    land(tmp_path, "liquidacoes_mercado", "c.csv", "Data do movimento;SIGLA;VENCIMENTO;NUM DE OPER;QUANT NEGOCIADA;PU MED\n16/01/2026;LTN;01/01/2030;7;3;4\n")
    land(tmp_path, "liquidacoes_mercado", "d.csv", "no;header\n1;2\n")
    land(tmp_path, "liquidacoes_mercado", "e.csv", "")
    report = run(spark, tmp_path, "liquidacoes_mercado")
    assert settlements(spark, tmp_path) == [("2026-01-14", "LTN", 5, 10.5, 1000.5), ("2026-01-15", "LFT", 1, None, 2.0), ("2026-01-15", "LTN", 6, 10.0, 900.5), ("2026-01-16", "LTN", 7, 3.0, 4.0)]
    assert report[("bronze", "liquidacoes_mercado")].rejected == 2
    # The file that couldn't be used is not taken in: it comes once it is right.
    land(tmp_path, "liquidacoes_mercado", "d.csv", HEAD + "19/01/2026;LTN;01/01/2030;1;1;1\n")
    run(spark, tmp_path, "liquidacoes_mercado")
    assert len(settlements(spark, tmp_path)) == 5


def test_zipped_settlements_as_plain_ones(spark, tmp_path):
    one, two = HEAD + "14/01/2026;LTN;01/01/2030;5;10,5;1000,5\n15/01/2026;\"L;FT\";01/01/2030;5;1;2\n", SWAPPED + "LTN;16/01/2026;01/01/2030;6;900,5;10;X\n"
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    land(plain, "liquidacoes_mercado", "a.csv", one)
    land(plain, "liquidacoes_mercado", "b.csv", two)
    land(packed, "liquidacoes_mercado", "NegE202601.ZIP", zipped(a__csv=one, b__csv=two, readme__md="x"))
    land(packed, "liquidacoes_mercado", "broken.zip", zipped(a__csv=one)[:60])
    assert run(spark, plain, "liquidacoes_mercado")[("bronze", "liquidacoes_mercado")].rejected == 0
    assert run(spark, packed, "liquidacoes_mercado")[("bronze", "liquidacoes_mercado")].rejected == 1
    assert settlements(spark, plain) == settlements(spark, packed) and len(settlements(spark, plain)) == 3


def test_month_first_dates_keep_their_day(spark, tmp_path):
    """A month-first reading that bronze chose is the day in silver and gold too."""
    land(tmp_path, "liquidacoes_mercado", "a.csv", HEAD + "01/14/2026;LTN;01/01/2030;5;10,5;1000,5\n")
    run(spark, tmp_path, "liquidacoes_mercado")
    assert [x[0] for x in settlements(spark, tmp_path)] == ["2026-01-14"]


def test_futures_by_name_prefix_and_file_day(spark, tmp_path):
    head = "RptDt;TckrSymb;ISIN;XprtnDt;AdjstdQtTax;AdjstdQt\n"
    land(tmp_path, "ajustes_bmf", "20260115/AJ20260115_1.csv", head + "2026-01-15;DI1F27;BR1;2027-01-01;1;1\n")
    land(tmp_path, "ajustes_bmf", "20260115/AJ20260115_2.csv", "TckrSymb;RptDt;ISIN;XprtnDt;AdjstdQt;AdjstdQtTax;More\nDI1F27;2026-01-15;BR1;2027-01-01;20;13,5;x\n")
    land(tmp_path, "ajustes_bmf", "20260115/OTHER20260115_9.csv", head + "2026-01-15;DI1F27;BR1;2027-01-01;7;7\n")
    land(tmp_path, "ajustes_bmf", "20260116/AJ20260116_1.csv", "TckrSymb;ISIN;XprtnDt;AdjstdQtTax;AdjstdQt\nDI1F27;BR1;2027-01-01;3;4\n")
    for n, name in enumerate(("20260115/AJ20260115_1.csv", "20260115/AJ20260115_2.csv", "20260115/OTHER20260115_9.csv")):
        os.utime(tmp_path / "landing" / "ajustes_bmf" / name, (1_700_000_000 + 10 * n,) * 2)
    run(spark, tmp_path, "ajustes_bmf", futures_prefix="AJ")
    got = sorted((str(r.data_referencia), r.taxa_ajuste, r.quantidade_ajuste) for r in read_data(spark, str(tmp_path)).ajustes_bmf.fetch_all().collect())
    assert got == [("2026-01-15", 13.5, 20.0), ("2026-01-16", 3.0, 4.0)]


def quote(day, **more):
    return {"tipo_titulo": "LTN", "data_vencimento": "2030-01-01", "data_referencia": day, "taxa_indicativa": "12.1", "intervalo_min_d0": 1,
            "intervalo_max_d0": 2, "intervalo_min_d1": 3, "intervalo_max_d1": 4, "pu": 700.5, **more}


def test_columns_that_come_later(spark, tmp_path):
    land(tmp_path, "mercado_secundario", "a.json", json.dumps([quote("2026-01-14")]))
    run(spark, tmp_path, "mercado_secundario")
    land(tmp_path, "mercado_secundario", "b.json", json.dumps([quote("2026-01-15", expressao="X+1", codigo_isin="BR1")]))
    run(spark, tmp_path, "mercado_secundario")
    got = sorted((str(r.data_referencia), r.expressao, r.codigo_isin) for r in read_data(spark, str(tmp_path)).mercado_secundario.fetch_all().collect())
    assert got == [("2026-01-14", None, None), ("2026-01-15", "X+1", "BR1")]
    names = registry.columns(spark, str(tmp_path), "silver", "mercado_secundario").names
    assert names.index("expressao") > names.index("pu")


def test_a_column_whose_type_changes_is_an_error(spark, tmp_path):
    from pyspark.sql import types as T

    registry.register(spark, str(tmp_path), "bronze", "cdi", T.StructType([T.StructField("a", T.LongType())]))
    registry.register(spark, str(tmp_path), "bronze", "cdi", T.StructType([T.StructField("b", T.LongType()), T.StructField("A", T.LongType())]))
    with pytest.raises(registry.ColumnTypeError):
        registry.register(spark, str(tmp_path), "bronze", "cdi", T.StructType([T.StructField("a", T.StringType())]))
    assert registry.columns(spark, str(tmp_path), "bronze", "cdi").names == ["a", "b"]


def test_inflation_tables_of_three_layouts_in_one_run(spark, tmp_path):
    head = list(landing.SIDRA_HEADER)
    land(tmp_path, "ipca_indice", "x1.parquet", pd.DataFrame({"DATA_CODIGO": ["202601", "202601"], "VAR_CODIGO": ["2266", "63"], "VALOR": [7000.5, 0.4]}))
    land(tmp_path, "ipca_indice", "x2.parquet", pd.DataFrame({"D2C": [202602, 202602], "D3C": ["2266", "63"], "V": ["7.010,5", "0,5"]}))
    land(tmp_path, "ipca_indice", "x3.parquet", pd.DataFrame([["t"] * 5, head[::-1], ["7020.5", "i", "2266", "202603", "m"], ["0.6", "%", "63", "202603", "m"]], columns=list("abcde")))
    land(tmp_path, "ipca_indice", "bad.parquet", pd.DataFrame({"q": ["1"], "r": ["2"]}))
    land(tmp_path, "ipca_indice", "text.parquet", "no parquet at all")
    report = run(spark, tmp_path, "ipca_indice", hi="2026-04-30", data_start="2026-01-01")
    from cupom.sources import lake as L

    got = {str(r.ref_month): (r.ipca_index, r.ipca_mom) for r in L.read_layer(spark, str(tmp_path), "silver", "ipca_indice").collect()}
    assert got == {"2026-01-01": (7000.5, 0.4), "2026-02-01": (7010.5, 0.5), "2026-03-01": (7020.5, 0.6)}
    assert report[("bronze", "ipca_indice")].rejected == 2


CASES = {
    "lines": '{"a": 1}\n\n{"a": 2}\n',
    "broken first line": '{"a": \n{"a": 1}\n{"a": 2}\n',
    "broken inside": '{"a": 1}\noops\n{"a": 2}\n',
    "indented twice": json.dumps({"a": 1}, indent=2) + "\n" + json.dumps([{"a": 2}], indent=1),
    "on one line": '{"a": 1}{"a": 2}',
    "list and more": '[{"a": 1}] [{"a": 2}]\n',
    "braces in text": '{"a": 1, "t": "}{ [\\" ] }{"}\n{"a": 2, "t": "{"}',
    "cut off": '{"a": 1}\n[\n {"a": 9},\n {"a": 8}\n',
    "indented after broken": '{"x": [1,\n' + json.dumps({"a": 1}, indent=2) + '\n{"a": 2}\n',
}
BROKEN = {"broken first line": 1, "broken inside": 1, "cut off": 1, "indented after broken": 1}


@pytest.mark.parametrize("block", [None, 20])
def test_json_roots(spark, tmp_path, block):
    for n, (name, text) in enumerate(CASES.items()):
        (tmp_path / f"{n} {name}.json").write_text(text)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block or kept).removesuffix("b"))
    try:
        rows = json_values.json_records(spark, [str(tmp_path / f"{n} {name}.json") for n, name in enumerate(CASES)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    for n, name in enumerate(CASES):
        mine = sorted((r for r in rows if f"/{n}%20" in r._seq.f), key=lambda r: r._seq.r)
        want = ["1"] if name == "cut off" else ["1", "2"]
        assert [r.a for r in mine if r._corrupt_record is None] == want, name
        assert sum(r._corrupt_record is not None for r in mine) == BROKEN.get(name, 0), (name, mine)


def test_nested_records_have_dotted_names(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": {"b": 1, "c d": {"e": "x"}}, "l": [1, {"z": 2}], "Q": "1"}, {"a": {"b": 2.50}, "q": "2"}, 7]\n[{"a": {"b": 3}}]\n3\n[]\n')
    got = json_values.json_records(spark, [str(tmp_path / "a.json")])
    assert set(got.columns) == {"a.b", "_corrupt_record", "_seq"}
    rows = got.collect()
    assert [r["a.b"] for r in rows if r._corrupt_record is None] == ["3"] and sum(r._corrupt_record is not None for r in rows) == 2
    (tmp_path / "b.json").write_text('[{"a": {"b": 1, "c d": {"e": "x"}}, "l": [1, {"z": 2}], "Q": "1"}, {"a": {"b": 2.5}, "q": "2"}]')
    rows = json_values.json_records(spark, [str(tmp_path / "b.json")]).collect()
    assert [(r["a.b"], r["a.c d.e"], r["l"]) for r in rows] == [("1", "x", '[1,{"z":2}]'), ("2.5", None, None)]
    assert sorted((r["Q"] if "Q" in r.asDict() else r["q"]) for r in rows) == ["1", "2"]


def test_listed_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"year": 2026, "registros": [{"n": 1}, {"n": 2}]}\n{"year": 2027, "registros": []}\n{"n": 3}\n')
    rows = json_values.json_records(spark, [str(tmp_path / "a.json")], "registros").orderBy("_seq").collect()
    assert [(r.year, r.n) for r in rows] == [("2026", "1"), ("2026", "2"), (None, "3")] and not any(r._corrupt_record for r in rows)


def test_header_names(spark):
    assert tabular._cells('﻿A;"b;c";;A;a ', ";") == ("A", "b;c", "_c2", "A_3", "a_4")
