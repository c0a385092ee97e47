"""Gold jobs: dimensions and facts, each upserted on its natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.jobs.lake import Lake
from tidemark.operators import calendar, gold
from tidemark.schemas import CALENDAR_DEFAULT_END, CALENDAR_DEFAULT_START, KEYS


def build_dim_company(spark: SparkSession, lake: Lake, tickers: DataFrame) -> int:
    """Upsert ``dim_company`` from the ticker reference table."""
    return lake.upsert(spark, gold.build_dim_company(tickers), "dim_company", KEYS["dim_company"])


def build_dim_date(spark: SparkSession, lake: Lake, start=CALENDAR_DEFAULT_START, end=CALENDAR_DEFAULT_END,
                   from_silver: bool = False, exclude_holidays: bool = False) -> int:
    """Fixed bounds, or (``from_silver``) Silver prices' date range +/- 1 year.

    ``is_trading_day_gpw`` is Monday-Friday; with ``exclude_holidays`` Polish
    public holidays (rule-based, incl. Easter-dependent ones) are not trading days.
    """
    if from_silver:
        cal = calendar.date_dimension_from(lake.read(spark, "silver_prices"), "date", pad_months=12)
    else:
        cal = calendar.date_dimension(spark, start, end)
    if exclude_holidays:
        cal = calendar.with_holidays(cal, calendar.holiday_table(cal))
    return lake.upsert(spark, cal, "dim_date", KEYS["dim_date"])


def build_fact_prices(spark: SparkSession, lake: Lake) -> int:
    """Upsert ``fact_prices`` from Silver prices (canonical projection)."""
    return lake.upsert(spark, gold.build_fact_prices(lake.read(spark, "silver_prices")), "fact_prices",
                       KEYS["fact_prices"])


def build_fact_fundamentals(spark: SparkSession, lake: Lake) -> int:
    """Upsert ``fact_fundamentals`` from Silver fundamentals."""
    return lake.upsert(spark, gold.build_fact_fundamentals(lake.read(spark, "silver_fundamentals")),
                       "fact_fundamentals", KEYS["fact_fundamentals"])


def build_fact_macro(spark: SparkSession, lake: Lake) -> int:
    """Upsert ``fact_macro`` from Silver macro."""
    return lake.upsert(spark, gold.build_fact_macro(lake.read(spark, "silver_macro")), "fact_macro",
                       KEYS["fact_macro"])
