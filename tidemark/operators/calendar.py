"""Generated tables: calendar dimension, backfill chunks and request grids.

All generators are per-row ``explode(sequence(...))``; no cross joins.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import (
    CALENDAR_DEFAULT_END,
    CALENDAR_DEFAULT_START,
    DAY_NAME_FORMAT,
    FX_MAX_RANGE_DAYS,
    MONTH_NAME_FORMAT,
    TRADING_WEEKDAYS,
)


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(d))


def calendar_attributes(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The nine calendar columns for a date column (weekday = Mon..Fri)."""
    d = F.col(date_col)
    return df.select(
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, MONTH_NAME_FORMAT).alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, DAY_NAME_FORMAT).alias("day_name"),
        F.dayofweek(d).between(*TRADING_WEEKDAYS).alias("is_trading_day_gpw"),
    )


def _days(start: Column, end: Column) -> Column:
    # explicit +1 day step: without it sequence() counts down when start > end
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def date_dimension(spark: SparkSession, start=CALENDAR_DEFAULT_START, end=CALENDAR_DEFAULT_END
                   ) -> DataFrame:
    """Every date in [start, end] with its attributes; start after end raises."""
    days = spark.range(1).select(_days(_date_lit(start), _date_lit(end)).alias("date"))
    return calendar_attributes(days)


def date_dimension_from(df: DataFrame, column: str, pad_months: int = 12) -> DataFrame:
    """Calendar whose bounds come from the data: [min - pad, max + pad].

    One plan: a global min/max aggregate (partial per task, one row out)
    feeds the generator; nothing goes through the driver.
    """
    c = F.to_date(F.col(column))
    bounds = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).where(F.col("lo").isNotNull())
    days = bounds.select(_days(F.add_months("lo", -pad_months), F.add_months("hi", pad_months)).alias("date"))
    return calendar_attributes(days)


def with_holidays(calendar: DataFrame, holidays: DataFrame, date_col: str = "date") -> DataFrame:
    """Trading day = weekday and not a public holiday (holiday table joined)."""
    h = holidays.select(F.col(date_col).alias("__h")).distinct()
    j = calendar.join(h, F.col("date") == F.col("__h"), "left")
    return j.withColumn("is_trading_day_gpw",
                        F.col("is_trading_day_gpw") & F.col("__h").isNull()).drop("__h")


def chunk_ranges(df: DataFrame, start_col: str, end_col: str, max_days: int = FX_MAX_RANGE_DAYS
                 ) -> DataFrame:
    """Split each inclusive [start, end] into chunks of at most ``max_days``.

    Adds ``chunk_start`` / ``chunk_end``; a range with start after end gives
    no chunk (filtered before ``sequence``, which would raise).
    """
    s, e = F.to_date(F.col(start_col)), F.to_date(F.col(end_col))
    # guarded inside the expression too: with literal bounds the optimizer may
    # evaluate the generator before the row filter
    starts = F.when(s <= e, F.sequence(s, e, F.expr(f"INTERVAL {int(max_days)} DAYS")))
    out = df.where(s <= e).withColumn("chunk_start", F.explode(starts))
    return out.withColumn("chunk_end", F.least(F.date_add("chunk_start", max_days - 1), e))


def chunk_date_range(spark: SparkSession, start, end, max_days: int = FX_MAX_RANGE_DAYS) -> DataFrame:
    """(chunk_start, chunk_end) rows covering [start, end]."""
    one = spark.range(1).select(_date_lit(start).alias("s"), _date_lit(end).alias("e"))
    return chunk_ranges(one, "s", "e", max_days).select("chunk_start", "chunk_end")


def year_grid(df: DataFrame, first_year: Column | int, last_year: Column | int,
              year_col: str = "year") -> DataFrame:
    """Each input row once per year in [first, last] (e.g. indicator x year)."""
    lo = first_year if isinstance(first_year, Column) else F.lit(first_year)
    hi = last_year if isinstance(last_year, Column) else F.lit(last_year)
    return df.where(lo <= hi).withColumn(year_col, F.explode(F.when(lo <= hi, F.sequence(lo, hi))))


# ---------------------------------------------------------------------------
# Polish statutory public holidays on fixed dates, as
# (month, day, first year in force). Movable feasts follow Easter Sunday:
# Easter Sunday +0, Easter Monday +1, Pentecost Sunday +49, Corpus Christi +60.
PL_FIXED_HOLIDAYS = [
    (1, 1, 1951), (1, 6, 2011), (5, 1, 1951), (5, 3, 1990), (8, 15, 1989),
    (11, 1, 1951), (11, 11, 1989), (12, 24, 2025), (12, 25, 1951), (12, 26, 1951),
]
PL_EASTER_OFFSETS = [0, 1, 49, 60]
# ---------------------------------------------------------------------------


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian algorithm),
    as integer column arithmetic — no lookup table, no UDF."""
    def div(a, b):
        return F.floor(a / F.lit(b)).cast("int")

    def mod(a, b):
        return F.pmod(a, F.lit(b))
    y = year.cast("int")
    a, b, c = mod(y, 19), div(y, 100), mod(y, 100)
    d, e = div(b, 4), mod(b, 4)
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = mod(19 * a + b - d - g + 15, 30)
    i, k = div(c, 4), mod(c, 4)
    l_ = mod(32 + 2 * e + 2 * i - h - k, 7)
    m = div(a + 11 * h + 22 * l_, 451)
    n = h + l_ - 7 * m + 114
    return F.make_date(y, div(n, 31), mod(n, 31) + 1)


def is_pl_public_holiday(date: Column) -> Column:
    """True on Polish public holidays (rule-based, any year)."""
    y, md = F.year(date), F.month(date) * 100 + F.dayofmonth(date)
    fixed = F.lit(False)
    for mo, dd, since in PL_FIXED_HOLIDAYS:
        fixed = fixed | ((md == mo * 100 + dd) & (y >= since))
    diff = F.datediff(date, easter_sunday(y))
    return fixed | diff.isin(*PL_EASTER_OFFSETS)


def holiday_table(calendar: DataFrame) -> DataFrame:
    """Holiday dates inside a calendar's range (small: ~14 per year)."""
    return calendar.where(is_pl_public_holiday(F.col("date"))).select("date")
