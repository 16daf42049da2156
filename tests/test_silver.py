import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.plans import silver
from cupom.sources.feeds import PROJECOES_RECORD, VNA_DAY
from cupom.operators.reshape import flatten_payload

D = dt.date


def test_ptax_keeps_type_a_usd(spark):
    df = spark.createDataFrame([
        ("2026-01-15", 220, "A", "USD", 5.1, 5.2, 1.0, 1.0),
        ("2026-01-15", 220, "I", "USD", 5.3, 5.4, 1.0, 1.0),
    ], "data string, codigo long, tipo string, moeda string, taxa_compra double, taxa_venda double, "
       "paridade_compra double, paridade_venda double")
    out = silver.ptax(df).collect()
    assert len(out) == 1 and out[0].ptax_compra == 5.1 and out[0].data_referencia == D(2026, 1, 15)
    assert silver.ptax(df).columns == list(silver.PTAX_COLUMNS)


def test_cdi_rename_and_date_filter(spark):
    df = spark.createDataFrame([("2026-01-15", "14.75", "2026-01-15"), ("2026-01-16", "14.76", "2026-01-15")],
                               "data_referencia string, estimativa_taxa_selic string, p string")
    out = silver.cdi(df, "p").collect()
    assert [(r.data_referencia, r.cdi) for r in out] == [(D(2026, 1, 15), 14.75)]


def test_ipca_abbreviated_layout_pivots(spark):
    df = spark.createDataFrame([("202601", "2266", "100.0", "f"), ("202601", "63", "0.5", "f"),
                                ("202601", "99", "1", "f")], "D2C string, D3C string, V string, _file string")
    out = silver.ipca_indice(df).collect()
    assert [(r.ref_month, r.ipca_index, r.ipca_mom) for r in out] == [(D(2026, 1, 1), 100.0, 0.5)]


def test_ipca_duplicate_keys_raise(spark):
    import pytest

    df = spark.createDataFrame([("202601", "2266", "100.0", "f"), ("202601", "2266", "101.0", "f")],
                               "D2C string, D3C string, V string, _file string")
    with pytest.raises(ValueError):
        silver.ipca_indice(df)


def test_ipca_comma_column(spark):
    df = spark.createDataFrame([("202601", "2266", "7.123,45", "f"), ("202601", "63", "0,5", "f")],
                               "D2C string, D3C string, V string, _file string")
    r = silver.ipca_indice(df).first()
    assert (r.ipca_index, r.ipca_mom) == (7123.45, 0.5)


def test_projecoes_keep_every_revision(spark):
    payload = [
        {"indice": "IPCA", "tipo_projecao": "PROJEÇÕES PARA O MÊS CORRENTE", "data_coleta": "2026-05-05",
         "mes_referencia": "05/2026", "variacao_projetada": 0.45, "data_validade": None},
        {"indice": "IPCA", "tipo_projecao": "PROJEÇÕES PARA O MÊS CORRENTE", "data_coleta": "2026-05-12",
         "mes_referencia": "05/2026", "variacao_projetada": 0.47, "data_validade": None},
        [{"indice": "IGP-M", "tipo_projecao": "PROJEÇÕES PARA O MÊS SEGUINTE", "data_coleta": "2026-05-05",
          "mes_referencia": "06/2026", "variacao_projetada": 0.3, "data_validade": "2026-06-30"}],
        {"indice": " IGP-M ", "tipo_projecao": "PROJEÇÕES PARA O MÊS SEGUINTE", "data_coleta": "2026-05-12",
         "mes_referencia": "06/2026", "variacao_projetada": 0.31, "data_validade": None},
    ]
    # A list mixing records and lists is flattened record by record.
    flat = [p for x in payload for p in (x if isinstance(x, list) else [x])]
    text = spark.createDataFrame([(json.dumps(flat),)], "value string")
    recs = text.select(F.explode(flatten_payload(F.col("value"), PROJECOES_RECORD)).alias("r")).select("r.*")
    out = silver.projecoes(recs).collect()
    assert len(out) == 4
    assert {r.ref_month for r in out} == {D(2026, 5, 1), D(2026, 6, 1)}
    assert {r.indice for r in out} == {"IPCA", "IGP-M"}


def test_flatten_payload_shapes(spark):
    rec = T.StructType([T.StructField("a", T.StringType())])
    df = spark.createDataFrame([('{"a": "1"}',), ('[{"a": "2"}, {"a": "3"}]',), ('[[{"a": "4"}], [{"a": "5"}]]',),
                                ("[]",)], "v string")
    got = sorted(r.a for r in df.select(F.explode(flatten_payload(F.col("v"), rec)).alias("r")).select("r.a").collect())
    assert got == ["1", "2", "3", "4", "5"]


def _vna_frame(spark, days):
    text = spark.createDataFrame([(json.dumps(days),)], "value string")
    arr = F.from_json("value", T.ArrayType(VNA_DAY))
    return text.select(F.posexplode(arr).alias("_p", "rec")).select(F.struct("_p").alias("_seq"), "rec")


def test_vna_case_aliases(spark):
    days = [{"Data": "2025-05-27", "itens": [{"codigoSelic": 760199, "VNA": "4321,5", "indice": "1",
                                               "tipoCorrecao": "P", "dataValidade": "27/05/2025"}]},
            {"data_referencia": "2025-05-27", "codigo_selic": "100000", "vna": "1"}]
    rows = silver.vna_records(_vna_frame(spark, days), "rec", ["_seq"])
    out = {r.codigo_selic: r for r in silver.vna(rows, order=["_seq", "_pos"]).collect()}
    assert out[760199].data_validade == D(2025, 5, 27) and out[760199].vna == 4321.5
    assert out[100000].vna == 1.0
    bad = [{"data": "2025-05-27", "titulos": [{"codigo_selic": "1", "vna": "4.321,5"}]}]
    rows = silver.vna_records(_vna_frame(spark, bad), "rec", ["_seq"])
    assert silver.vna(rows, order=["_seq", "_pos"]).count() == 0  # thousands dot → NULL value → dropped (F5)


def test_vna_nested_comma_and_keep_last(spark):
    days = [{"data_referencia": "2025-05-26", "titulos": [
        {"tipo_titulo": "NTN-B", "codigo_selic": "210100", "index": "14,65", "tipo_correcao": " O ",
         "data_validade": "2025-05-23", "vna": "16616,59"},
        {"codigo_selic": "210100", "index": "14,65", "tipo_correcao": "O", "data_validade": "2025-05-23",
         "vna": "200"},
        {"codigo_selic": None, "vna": "1"}]}]
    rows = silver.vna_records(_vna_frame(spark, days), "rec", ["_seq"])
    out = silver.vna(rows, order=["_seq", "_pos"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.data_referencia, r.codigo_selic, r["index"], r.vna, r.tipo_correcao) == (D(2025, 5, 26), 210100, 14.65,
                                                                                     200.0, "O")


def test_vna_partition_filter(spark):
    days = [{"data_referencia": d, "titulos": [{"codigo_selic": "1", "vna": "1", "index": "1", "tipo_correcao": "O",
                                                "data_validade": d}]} for d in ("2025-05-26", "2025-05-27")]
    rows = silver.vna_records(_vna_frame(spark, days), "rec", ["_seq"])
    dates = spark.createDataFrame([(D(2025, 5, 26),)], "d date")
    assert silver.vna(rows, dates=dates, order=["_seq", "_pos"]).count() == 1


def test_bmf_prefix_filter_and_comma(spark):
    df = spark.createDataFrame([("2026-05-25", "DI1F27", "BR1", "2027-01-01", "13,5", "100"),
                                ("2026-05-25", "DAPQ26", "BR2", "2026-08-15", "12,0", "50"),
                                ("2026-05-25", "WINQ26", "BR3", "2026-08-15", "1", "1"),
                                ("2026-05-25", None, "BR4", "2026-08-15", "1", "1")],
                               "RptDt string, TckrSymb string, ISIN string, XprtnDt string, AdjstdQtTax string, "
                               "AdjstdQt string")
    out = {r.ticker: r.taxa_ajuste for r in silver.ajustes_bmf(df).collect()}
    assert out == {"DI1F27": 13.5, "DAPQ26": 12.0}


def test_settlements_and_auctions(spark):
    liq = spark.createDataFrame([("15/01/2026", "5", "1.000,0", "1000,5", "LTN", "01/01/2030")],
                                "`DATA MOV` string, `NUM DE OPER` string, `QUANT NEGOCIADA` string, `PU MED` string, "
                                "SIGLA string, VENCIMENTO string")
    r = silver.liquidacoes_mercado(liq).first()
    assert (r.data_referencia, r.qtd_operacoes, r.qtd_titulos, r.pu_medio) == (D(2026, 1, 15), 5.0, None, 1000.5)
    lei = spark.createDataFrame([("2026-01-15", "LTN", "2030-01-01", "12", "1000"), ("bad", "LTN", "2030-01-01", "1", "1")],
                                "data_leilao string, titulo string, vencimento string, numero_edital string, oferta string")
    out = silver.leiloes(lei).collect()
    assert len(out) == 1 and out[0].numero_edital == 12 and out[0].oferta == 1000


def test_holidays(spark):
    df = spark.createDataFrame([("2026-01-02",), ("2026-01-01",), (None,), ("2026-01-01",)], "Data string")
    assert [r.data for r in silver.feriados(df).collect()] == [D(2026, 1, 1), D(2026, 1, 2)]
