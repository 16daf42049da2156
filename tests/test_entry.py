import importlib


def test_contract_shapes():
    entry = importlib.import_module("__spark_entry__")
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 30
    assert all(callable(f) for f in q.values())


def test_entry_runs_on_smoke_data(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "data_referencia" and "ipca_usado" in df.columns
