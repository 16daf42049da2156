"""Calendar operators (K1–K8) and the business-day machinery.

Calendars are generated with ``spark.range`` (distributed, no driver-side lists). Their size is
bounded by the number of days in the requested window, never by data volume.

Business-day shifts use an *ordinal* instead of a per-day loop: every business day gets its
rank ``bday_ord`` and every calendar day the number of business days up to it (``bday_cum``).
"n business days after d" is then an equi-join on ``bday_ord``; the running count is computed
per year and offset by a tiny per-year prefix sum, so no window ever runs over the whole spine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cupom.functions.coerce import ensure_date

# Days past the last date a shift may need, so that a run of holidays still finds a business day.
RUN_DAYS = 62

DAY_SCHEMA = T.StructType([T.StructField("d", T.DateType(), False)])


def _empty_days(spark: SparkSession, name: str = "d") -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(name, T.DateType(), False)]))


def calendar_days(spark: SparkSession, start, end, name: str = "d") -> DataFrame:
    """K1: every calendar day in [start, end]; an inverted range gives no rows."""
    s, e = ensure_date(start), ensure_date(end)
    if s > e:
        return _empty_days(spark, name)
    n = (e - s).days + 1
    return spark.range(n).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias(name))


def is_weekday(c: Column) -> Column:
    """Monday..Friday (``weekday`` is 0 for Monday)."""
    return F.weekday(c) < 5


def business_days(spark: SparkSession, start, end, holidays: DataFrame | None = None,
                  name: str = "d") -> DataFrame:
    """K2: weekdays in [start, end]. Holidays are kept unless a holiday frame is given (Q3 option)."""
    days = calendar_days(spark, start, end, name).where(is_weekday(F.col(name)))
    if holidays is not None:
        days = days.join(holidays.select(F.col(holidays.columns[0]).cast("date").alias(name)), name, "left_anti")
    return days


def months_in_range(spark: SparkSession, start, end, name: str = "month") -> DataFrame:
    """K3: first day of every month touching [start, end]; inverted → no rows."""
    s, e = ensure_date(start), ensure_date(end)
    if s > e:
        return _empty_days(spark, name)
    n = (e.year - s.year) * 12 + (e.month - s.month) + 1
    first = date(s.year, s.month, 1)
    return spark.range(n).select(F.add_months(F.lit(first), F.col("id").cast("int")).alias(name))


def days_between(bounds: DataFrame, start_col: str, end_col: str, name: str = "d") -> DataFrame:
    """K1 over a frame of windows: one row per day of each [start, end]; inverted windows vanish."""
    ok = bounds.where(F.col(start_col) <= F.col(end_col))
    return ok.withColumn(name, F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY"))))


def resolve_window(start=None, end=None, data_start="2026-01-01", today: date | None = None) -> tuple[date, date]:
    """K4: start = max(requested, history start); end defaults to today."""
    floor = ensure_date(data_start)
    s = max(ensure_date(start), floor) if start is not None else floor
    e = ensure_date(end) if end is not None else (today or date.today())
    return s, e


def add_months_py(d: date, n: int) -> date:
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    return date(y, m + 1, 1)


def inflation_lookback_start(start, months: int = 4) -> date:
    """K5: first day of (month of start) − ``months`` months."""
    s = ensure_date(start)
    return add_months_py(date(s.year, s.month, 1), -months)


def neighbour_months(c: Column) -> Column:
    """K7: array(previous, current, next) first-of-month dates of a date column."""
    m = F.trunc(c, "MM")
    return F.array(F.add_months(m, -1), m, F.add_months(m, 1))


def split_windows(spark: SparkSession, start, end, years: int) -> DataFrame:
    """K8: cut [start, end] into consecutive windows of at most ``years`` years."""
    s, e = ensure_date(start), ensure_date(end)
    if s > e:
        schema = "win_start date, win_end date"
        return spark.createDataFrame([], schema)
    n = (e.year - s.year) // years + 1
    starts = spark.range(n).select(F.add_months(F.lit(s), (F.col("id") * 12 * years).cast("int")).alias("win_start"))
    nxt = F.date_sub(F.add_months(F.col("win_start"), 12 * years), 1)
    return (starts.where(F.col("win_start") <= F.lit(e))
            .select("win_start", F.least(nxt, F.lit(e)).alias("win_end")))


# ----------------------------------------------------------------------------- business days


def business_day_index(spark: SparkSession, start, end, holidays: DataFrame | None = None) -> DataFrame:
    """Spine [start, end] with ``is_bday`` (weekday and not a holiday) and ``bday_cum``.

    ``bday_cum`` = number of business days ≤ d (over the spine). Business days carry
    ``bday_ord`` = ``bday_cum``. Running counts are per-year windows plus a per-year offset.
    """
    return business_day_index_over(calendar_days(spark, start, end, "d"), holidays)


def business_day_index_over(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """:func:`business_day_index` over a given spine of consecutive days (column ``d``)."""
    if holidays is not None:
        hol = holidays.select(F.col(holidays.columns[0]).cast("date").alias("d")).distinct() \
            .withColumn("is_holiday", F.lit(True))
        days = days.join(hol, "d", "left")
    else:
        days = days.withColumn("is_holiday", F.lit(None).cast("boolean"))
    days = days.withColumn(
        "is_bday", (is_weekday(F.col("d")) & F.coalesce(~F.col("is_holiday"), F.lit(True))).cast("int")
    ).withColumn("yr", F.year("d")).drop("is_holiday")
    per_year = days.groupBy("yr").agg(F.sum("is_bday").alias("n_y"))
    # One row per year: the global window below runs over at most a few hundred rows.
    per_year = per_year.withColumn(
        "offset", F.coalesce(F.sum("n_y").over(Window.orderBy("yr").rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0)))
    within = F.sum("is_bday").over(Window.partitionBy("yr").orderBy("d")
                                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (days.withColumn("cum_in_year", within)
            .join(per_year.select("yr", "offset"), "yr")
            .select("d", F.col("is_bday").cast("boolean").alias("is_bday"),
                    (F.col("offset") + F.col("cum_in_year")).cast("long").alias("bday_cum")))


def _bday_by_ord(index: DataFrame, name: str) -> DataFrame:
    return index.where("is_bday").select(F.col("bday_cum").alias("_ord"), F.col("d").alias(name))


def shift_business_days(frame: DataFrame, date_col: str, n: int, index: DataFrame, out: str) -> DataFrame:
    """Add column ``out`` = the n-th business day after (n>0) or before (n<0) ``date_col``.

    n = 0 returns the date itself, as the upstream loop does. Dates outside the index → NULL.
    """
    if n == 0:
        return frame.withColumn(out, F.col(date_col))
    idx = index.select(F.col("d").alias("_d"), F.col("is_bday").alias("_isb"), F.col("bday_cum").alias("_cum"))
    j = frame.join(idx, frame[date_col] == idx["_d"], "left")
    if n > 0:
        target = F.col("_cum") + F.lit(n)
    else:
        target = F.col("_cum") - F.col("_isb").cast("long") + F.lit(n + 1)
    j = j.withColumn("_ord", target).drop("_d", "_isb", "_cum")
    return j.join(_bday_by_ord(index, out), "_ord", "left").drop("_ord")


def roll_forward(frame: DataFrame, date_col: str, index: DataFrame, out: str) -> DataFrame:
    """First business day on or after ``date_col`` (the date itself when it is one)."""
    idx = index.select(F.col("d").alias("_d"), F.col("is_bday").alias("_isb"), F.col("bday_cum").alias("_cum"))
    j = frame.join(idx, frame[date_col] == idx["_d"], "left")
    j = j.withColumn("_ord", F.col("_cum") - F.col("_isb").cast("long") + 1).drop("_d", "_isb", "_cum")
    return j.join(_bday_by_ord(index, out), "_ord", "left").drop("_ord")


def business_15th(months: DataFrame, month_col: str, index: DataFrame, out: str = "bday15") -> DataFrame:
    """B4 building block: the 15th of each month rolled forward to a business day."""
    f = months.withColumn("_15", F.make_date(F.year(month_col), F.month(month_col), F.lit(15)))
    return roll_forward(f, "_15", index, out).drop("_15")


def spine_for(dates: DataFrame, col: str, reach: int = 0) -> DataFrame:
    """Consecutive days around ``col`` for shifts of up to ``reach`` business days either way, computed on the
    cluster from the frame's own bounds (no driver round trip).

    A week has five weekdays, and a run of holidays is taken to last a month at most, so ``reach`` business days lie within
    7/5 ``reach`` + 62 calendar days (the months on both sides serve the business 15ths).
    """
    margin = RUN_DAYS + -(-7 * abs(reach) // 5)
    b = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    b = b.select(F.date_sub(F.add_months(F.trunc("lo", "MM"), -1), margin).alias("lo"),
                 F.date_add(F.add_months(F.trunc("hi", "MM"), 2), margin).alias("hi"))
    return days_between(b, "lo", "hi", "d").select("d")
