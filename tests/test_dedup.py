from pyspark.sql import functions as F

from cupom.operators.dedup import distinct_sorted, keep_first, keep_last


def test_keep_first_and_last_follow_explicit_order(spark):
    df = spark.createDataFrame([("2026-01-15", "DI1F27", 13.5, 2), ("2026-01-15", "DI1F27", 12.0, 1),
                                ("2026-01-15", "DAPQ26", 12.0, 3)], "d string, t string, v double, seq int")
    first = {r.t: r.v for r in keep_first(df, ["d", "t"], ["seq"]).collect()}
    last = {r.t: r.v for r in keep_last(df, ["d", "t"], ["seq"]).collect()}
    assert first == {"DI1F27": 12.0, "DAPQ26": 12.0}
    assert last == {"DI1F27": 13.5, "DAPQ26": 12.0}
    assert keep_first(df, ["d", "t"], ["seq"]).columns == df.columns


def test_keep_on_hot_key_and_struct_order(spark):
    # One key holds every row: the aggregate reduces it map-side; the result is still exact.
    df = spark.range(0, 50000).select(F.lit("k").alias("k"), F.col("id"),
                                      F.struct((F.col("id") % 7).alias("a"), (-F.col("id")).alias("b")).alias("o"))
    r = keep_last(df, ["k"], ["o"]).first()
    assert (r.o.a, r.o.b) == (6, -6)


def test_distinct_sorted(spark):
    df = spark.createDataFrame([("2026-01-02",), ("2026-01-01",), ("2026-01-02",)], "d string")
    assert [r.d for r in distinct_sorted(df, ["d"]).collect()] == ["2026-01-01", "2026-01-02"]
