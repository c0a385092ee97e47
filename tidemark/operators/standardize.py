"""Silver typing: parse-or-drop dates, period type, macro reference date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import iso_date_or_null, period_type, year_end_date
from tidemark.schemas import MACRO_COUNTRY, PAYLOAD_DATE_FORMAT


def parse_date_or_drop(df: DataFrame, column: str, fmt: str = PAYLOAD_DATE_FORMAT) -> DataFrame:
    """Replace a text date by ``DateType`` and drop rows that do not parse.

    A row without a valid date has no Silver identity (a null key never
    matches in an upsert and would duplicate on every rerun).
    """
    return df.withColumn(column, iso_date_or_null(column, fmt)).where(F.col(column).isNotNull())


def standardize_prices(df: DataFrame) -> DataFrame:
    """Parse ``date``; drop rows where it does not parse."""
    return parse_date_or_drop(df, "date")


def standardize_fx_rates(df: DataFrame) -> DataFrame:
    """Parse ``effective_date``; drop rows where it does not parse."""
    return parse_date_or_drop(df, "effective_date")


def standardize_fundamentals(df: DataFrame) -> DataFrame:
    """Parse the period-end date (drop failures) and derive ``period_type``."""
    return parse_date_or_drop(df, "date").withColumn("period_type", period_type("period"))


def standardize_macro(df: DataFrame, country: str = MACRO_COUNTRY) -> DataFrame:
    """Add the country label and the year-end ``reference_date``."""
    return df.withColumns({"country": F.lit(country), "reference_date": year_end_date("year")})
