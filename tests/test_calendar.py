import datetime as dt

from pyspark.sql import functions as F

from cupom.functions import calendar as cal

D = dt.date


def col(df, c="d"):
    return [r[0] for r in df.orderBy(c).select(c).collect()]


def test_calendar_and_business_days(spark):
    assert len(col(cal.calendar_days(spark, "2026-01-01", "2026-01-31"))) == 31
    assert col(cal.calendar_days(spark, "2026-02-01", "2026-01-01")) == []
    bd = col(cal.business_days(spark, "2026-01-01", "2026-01-11"))
    assert bd == [D(2026, 1, d) for d in (1, 2, 5, 6, 7, 8, 9)]  # holidays are not removed (K2)
    hol = spark.createDataFrame([(D(2026, 1, 1),)], "data date")
    assert D(2026, 1, 1) not in col(cal.business_days(spark, "2026-01-01", "2026-01-11", hol))
    assert col(cal.months_in_range(spark, "2026-01-15", "2026-03-02"), "month") == [D(2026, 1, 1), D(2026, 2, 1),
                                                                                    D(2026, 3, 1)]


def test_shift_and_roll(spark):
    hol = spark.createDataFrame([(D(2026, 2, 16),), (D(2026, 2, 17),)], "data date")  # carnival
    idx = cal.business_day_index(spark, "2025-12-01", "2026-04-30", hol)
    f = spark.createDataFrame([(D(2026, 2, 13),), (D(2026, 2, 14),), (D(2026, 2, 18),)], "d date")
    x = cal.shift_business_days(f, "d", 1, idx, "nxt")
    x = cal.shift_business_days(x, "d", -1, idx, "prv")
    x = cal.roll_forward(x, "d", idx, "roll")
    got = {r.d: (r.nxt, r.prv, r.roll) for r in x.collect()}
    assert got[D(2026, 2, 13)] == (D(2026, 2, 18), D(2026, 2, 12), D(2026, 2, 13))
    assert got[D(2026, 2, 14)] == (D(2026, 2, 18), D(2026, 2, 13), D(2026, 2, 18))
    assert got[D(2026, 2, 18)] == (D(2026, 2, 19), D(2026, 2, 13), D(2026, 2, 18))


def test_business_15th(spark):
    idx = cal.business_day_index(spark, "2026-01-01", "2026-12-31", None)
    m = spark.createDataFrame([(D(2026, 2, 1),), (D(2026, 3, 1),)], "month date")
    got = {r.month: r.bday15 for r in cal.business_15th(m, "month", idx).collect()}
    assert got == {D(2026, 2, 1): D(2026, 2, 16), D(2026, 3, 1): D(2026, 3, 16)}


def test_windows_and_lookback(spark):
    w = cal.split_windows(spark, "2020-03-01", "2022-06-30", 1).orderBy("win_start").collect()
    assert [(r.win_start, r.win_end) for r in w] == [(D(2020, 3, 1), D(2021, 2, 28)), (D(2021, 3, 1), D(2022, 2, 28)),
                                                     (D(2022, 3, 1), D(2022, 6, 30))]
    assert cal.inflation_lookback_start("2026-01-15") == D(2025, 9, 1)
    assert cal.resolve_window("2025-01-01", "2026-02-01") == (D(2026, 1, 1), D(2026, 2, 1))
    arr = spark.createDataFrame([(D(2026, 1, 15),)], "d date").select(cal.neighbour_months(F.col("d")).alias("a"))
    assert arr.first().a == [D(2025, 12, 1), D(2026, 1, 1), D(2026, 2, 1)]
