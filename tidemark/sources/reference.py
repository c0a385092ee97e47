"""Reference data (tickers, currencies, macro indicators) as small tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import CURRENCIES, MACRO_INDICATORS, TICKERS


def _table(spark: SparkSession, rows_or_path, schema) -> DataFrame:
    if isinstance(rows_or_path, str):
        reader = spark.read.schema(schema)
        if rows_or_path.endswith(".csv"):
            return reader.option("header", True).csv(rows_or_path)
        return reader.option("multiLine", True).json(rows_or_path)
    rows = [tuple(r.get(f.name) for f in schema.fields) if isinstance(r, Mapping) else tuple(r)
            for r in rows_or_path]
    return spark.createDataFrame(rows, schema)


def tickers_table(spark: SparkSession, rows_or_path: str | Iterable) -> DataFrame:
    """(ticker, stooq_symbol, fmp_symbol, company_name, currency)."""
    return _table(spark, rows_or_path, TICKERS)


def currencies_table(spark: SparkSession, rows_or_path: str | Iterable) -> DataFrame:
    """(code, name)."""
    return _table(spark, rows_or_path, CURRENCIES)


def macro_indicators_table(spark: SparkSession, rows_or_path: str | Iterable) -> DataFrame:
    """(name, gus_variable_id, unit)."""
    return _table(spark, rows_or_path, MACRO_INDICATORS)
