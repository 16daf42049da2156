import datetime as dt

import pytest

from cupom.plans.reader import read_data
from cupom.sinks import tables

D = dt.date

QUOTE_COLS = ("tipo_titulo string, data_vencimento date, data_referencia date, taxa_anbima double, "
              "intervalo_min_d0 double, intervalo_max_d0 double, intervalo_min_d1 double, intervalo_max_d1 double, "
              "pu double, expressao string, data_base date, codigo_selic string, codigo_isin string, "
              "taxa_compra double, taxa_venda double, desvio_padrao double, status string")
LIQ_COLS = ("tipo_titulo string, data_vencimento date, data_referencia date, qtd_operacoes long, qtd_titulos double, "
            "pu_medio double, expressao string, data_base date, codigo_selic string, codigo_isin string, status string")


def quote(t, v, d, pu):
    return (t, v, d, 10.0, None, None, None, None, pu, None, None, "100000", "BR1", None, None, None, "ATIVO")


def liq(t, v, d, n):
    return (t, v, d, n, 1.0, 1000.0, None, None, None, None, "ATIVO")


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    q = spark.createDataFrame([quote("LTN", D(2030, 1, 1), D(2026, 1, 10), 900.0),
                               quote("NTN-B", D(2035, 5, 15), D(2026, 1, 12), 4000.0)], QUOTE_COLS)
    s = spark.createDataFrame([liq("LTN", D(2030, 1, 1), D(2026, 1, 10), 5),
                               liq("LFT", D(2029, 3, 1), D(2026, 1, 11), 7)], LIQ_COLS)
    tables.upsert(spark, root, "MERCADO_SECUNDARIO", q)
    tables.upsert(spark, root, "LIQUIDACOES_MERCADO", s)
    cdi = spark.createDataFrame([(D(2026, 1, 2), 14.0), (D(2026, 1, 3), 14.1), (D(2026, 1, 5), 14.2)],
                                "data_referencia date, cdi double")
    tables.upsert(spark, root, "CDI", cdi)
    return root


def test_full_outer_combined_view(spark, lake):
    r = read_data(spark, lake)
    out = r.mercado_com_liquidacoes.fetch_all().collect()
    assert len(out) == 3
    by = {(x.tipo_titulo, x.data_referencia): x for x in out}
    assert by[("LTN", D(2026, 1, 10))].pu == 900.0 and by[("LTN", D(2026, 1, 10))].qtd_operacoes == 5
    assert by[("NTN-B", D(2026, 1, 12))].qtd_operacoes is None and by[("NTN-B", D(2026, 1, 12))].status_liq is None
    assert by[("LFT", D(2026, 1, 11))].pu is None and by[("LFT", D(2026, 1, 11))].status_liq == "ATIVO"


def test_latest_on_union_of_dates(spark, lake):
    out = read_data(spark, lake).mercado_com_liquidacoes.fetch_latest(2).collect()
    assert {x.data_referencia for x in out} == {D(2026, 1, 11), D(2026, 1, 12)} and len(out) == 2


def test_series_reads(spark, lake):
    cdi = read_data(spark, lake).cdi
    assert [x.cdi for x in cdi.fetch_range("2026-01-02", "2026-01-04").collect()] == [14.0, 14.1]
    assert [x.data_referencia for x in cdi.fetch_latest(1).collect()] == [D(2026, 1, 5)]
    assert [x.cdi for x in cdi.fetch_on("2026-01-03").collect()] == [14.1]
    with pytest.raises(ValueError):
        cdi.fetch_latest(0)
    with pytest.raises(ValueError):
        cdi.fetch_range("2026-01-05", "2026-01-01")


def test_snapshot_readers_and_kwargs(spark, lake):
    r = read_data(spark, lake)
    with pytest.raises(TypeError):
        r.feriados.fetch_latest(1)
    with pytest.raises(TypeError):
        r.titulos_publicos.fetch_on("2026-01-01")
    assert r.feriados.fetch_all().count() == 0  # never written → empty with the schema
    with pytest.raises(TypeError):
        read_data(spark, lake, db_path="x")


def test_upsert_replaces_whole_row_and_checks_columns(spark, tmp_path):
    root = str(tmp_path / "lake2")
    cols = ("data_referencia date, codigo_selic long, tipo_correcao string, index double, data_validade date, "
            "vna double, vna_ajustado double")
    base = spark.createDataFrame([(D(2026, 1, 15), 210100, "O", 1.0, D(2026, 1, 14), 100.0, None),
                                  (D(2026, 2, 2), 210100, "O", 1.0, D(2026, 2, 1), 50.0, None)], cols)
    tables.upsert(spark, root, "VNA", base)
    tables.upsert(spark, root, "VNA", spark.createDataFrame(
        [(D(2026, 1, 15), 210100, "O", 1.0, D(2026, 1, 14), 200.0, None)], cols))
    got = {r.data_referencia: r.vna for r in read_data(spark, root).vna.fetch_all().collect()}
    assert got == {D(2026, 1, 15): 200.0, D(2026, 2, 2): 50.0}
    with pytest.raises(ValueError, match="unknown .*extra"):
        tables.upsert(spark, root, "CDI", spark.createDataFrame([(D(2026, 1, 1), 1.0, 1)],
                                                                "data_referencia date, cdi double, extra int"))
    with pytest.raises(ValueError, match="lacking"):
        tables.upsert(spark, root, "CDI", spark.createDataFrame([(D(2026, 1, 1),)], "data_referencia date"))


def test_dimension_replace_vs_coalesce(spark, tmp_path):
    root = str(tmp_path / "lake3")
    q = spark.createDataFrame([quote("LTN", D(2030, 1, 1), D(2026, 1, 10), 900.0)], QUOTE_COLS)
    tables.upsert_with_dimension(spark, root, "MERCADO_SECUNDARIO", q, [])
    auctions = spark.createDataFrame([("LTN", D(2030, 1, 1), D(2026, 1, 20))],
                                     "tipo_titulo string, data_vencimento date, data_referencia date")
    existing = tables.read_table(spark, root, "TITULOS_PUBLICOS")
    kept = tables.bond_dimension_batch(auctions, ["data_referencia"], "coalesce", existing).first()
    assert kept.codigo_selic == "100000" and kept.status == "ATIVO"
    nulled = tables.bond_dimension_batch(auctions, ["data_referencia"], "replace").first()
    assert nulled.codigo_selic is None and nulled.status == "ATIVO"


def test_constraint_report(spark):
    df = spark.createDataFrame([(D(2026, 1, 1), 2), (D(2026, 1, 1), 3), (None, 5)], "data_referencia date, usa_fechado int")
    from cupom.operators.checks import constraint_violations

    got = {r.check_name: r.n_violations for r in
           constraint_violations(df, "IPCA_DICT", ["data_referencia"], ["usa_fechado"], {"usa_fechado": (0, 1)}).collect()}
    assert got == {"not_null:usa_fechado": 0, "in:usa_fechado": 3, "pk_not_null:data_referencia": 1, "pk_unique": 1}


def test_snapshot_top_n(spark, tmp_path):
    root = str(tmp_path / "lake4")
    hol = spark.createDataFrame([(D(2026, 1, 1),), (D(2026, 2, 16),), (D(2026, 2, 17),)], "data date")
    tables.replace_all(spark, root, "FERIADOS", hol)
    top = [r.data for r in read_data(spark, root).feriados.fetch_top(2).collect()]
    assert top == [D(2026, 2, 17), D(2026, 2, 16)]
