"""Gold star schema: canonical fact projections, company dimension, serving joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FACT_FUNDAMENTALS_COLUMNS, FACT_MACRO_COLUMNS, FACT_PRICES_COLUMNS


def canonical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to a Gold contract: fixed order, extras dropped, missing raises."""
    return df.select(*columns)


def build_fact_prices(silver_prices: DataFrame) -> DataFrame:
    """Silver prices -> the ``fact_prices`` contract."""
    return canonical(silver_prices, FACT_PRICES_COLUMNS)


def build_fact_fundamentals(silver_fundamentals: DataFrame) -> DataFrame:
    """Silver fundamentals -> the ``fact_fundamentals`` contract."""
    return canonical(silver_fundamentals, FACT_FUNDAMENTALS_COLUMNS)


def build_fact_macro(silver_macro: DataFrame) -> DataFrame:
    """Drops ``variable_id`` (a source detail) and ``year``."""
    return canonical(silver_macro, FACT_MACRO_COLUMNS)


def build_dim_company(tickers: DataFrame) -> DataFrame:
    """dim_company from the ticker reference table; ``fmp_symbol`` may be null."""
    return tickers.select(
        "ticker", "company_name", F.col("currency").alias("listing_currency"),
        F.col("fmp_symbol").cast("string").alias("fmp_symbol"))


def monthly_by_day_type(facts: DataFrame, calendar: DataFrame, date_col: str, measure: str,
                        extra_keys: Sequence[str] = ()) -> DataFrame:
    """Star join of a fact to the calendar, then a monthly rollup per day type.

    A left join: a fact outside the calendar keeps its month, and its day type
    falls back to Monday to Friday; a fact without a date groups under nulls. The
    aggregate is partial per task, so only (month, day type) groups shuffle; AQE
    picks the join from the sizes at run time.
    """
    cal = calendar.select(F.col("date").alias("__cal_date"), "year", "month", "is_trading_day_gpw")
    day = F.to_date(F.col(date_col))
    j = facts.withColumn("__day", day).join(cal, F.col("__day") == F.col("__cal_date"), "left")
    keys = {"year": F.coalesce("year", F.year("__day")), "month": F.coalesce("month", F.month("__day")),
            "is_trading_day_gpw": F.coalesce("is_trading_day_gpw", F.weekday("__day") < 5)}
    return (j.groupBy(*extra_keys, *[c.alias(n) for n, c in keys.items()])
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(measure).alias("sum_value"),
                 F.avg(measure).alias("avg_value")))
