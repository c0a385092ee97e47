import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, gold
from tidemark.schemas import FACT_MACRO_COLUMNS, FACT_PRICES_COLUMNS


def test_dim_date_week(spark):
    df = calendar.date_dimension(spark, "2024-01-01", "2024-01-07")
    rows = df.orderBy("date").collect()
    assert len(rows) == 7
    assert [r.is_trading_day_gpw for r in rows] == [True] * 5 + [False] * 2
    assert df.columns == ["date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_week",
                          "day_name", "is_trading_day_gpw"]


def test_dim_date_attributes(spark):
    r = calendar.date_dimension(spark, dt.date(2024, 3, 15), dt.date(2024, 3, 15)).first()
    assert (r.day_name, r.month_name, r.quarter, r.month, r.year, r.day_of_week) == ("Friday", "March", 1, 3, 2024, 6)
    assert calendar.date_dimension(spark, "2024-12-30", "2024-12-30").first().week_of_year == 1


def test_dim_date_start_after_end_raises(spark):
    with pytest.raises(Exception):
        calendar.date_dimension(spark, "2024-01-07", "2024-01-01").collect()


def test_chunks(spark):
    got = [(str(r.chunk_start), str(r.chunk_end))
           for r in calendar.chunk_date_range(spark, "2022-03-01", "2023-07-15").orderBy("chunk_start").collect()]
    assert got == [("2022-03-01", "2023-03-02"), ("2023-03-03", "2023-07-15")]
    assert calendar.chunk_date_range(spark, "2024-01-01", "2024-02-01").count() == 1
    assert calendar.chunk_date_range(spark, "2024-02-01", "2024-01-01").count() == 0


def test_year_grid(spark):
    ind = spark.createDataFrame([("cpi",), ("gdp",)], "name string")
    assert calendar.year_grid(ind, 2020, 2022).count() == 6


def test_holidays(spark):
    cal = calendar.date_dimension(spark, "2024-01-01", "2025-12-31")
    hol = {str(r.date) for r in calendar.holiday_table(cal).collect()}
    assert {"2024-04-01", "2024-05-30", "2024-03-31", "2024-05-19", "2025-04-21", "2025-12-24"} <= hol
    assert "2024-12-24" not in hol and "2024-04-02" not in hol
    flagged = calendar.with_holidays(cal, calendar.holiday_table(cal))
    assert flagged.where("date = '2024-04-01'").first().is_trading_day_gpw is False


def test_fact_projection_order_and_missing_column(spark):
    cols = FACT_PRICES_COLUMNS + ["extra"]
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"{c} int" for c in reversed(cols)))
    assert gold.build_fact_prices(df).columns == FACT_PRICES_COLUMNS
    with pytest.raises(Exception):
        gold.build_fact_prices(df.drop("volume"))


def test_fact_macro_drops_variable_id(spark):
    df = spark.createDataFrame([("cpi", 1, 2023, 1.0, "%", "gus", None, "PL", dt.date(2023, 12, 31))],
                               "indicator_name string, variable_id int, year int, value double, unit string, "
                               "source string, retrieved_at timestamp, country string, reference_date date")
    assert gold.build_fact_macro(df).columns == FACT_MACRO_COLUMNS


def test_dim_company(spark):
    t = spark.createDataFrame([("PKO", "pko", None, "PKO BP", "PLN")],
                              "ticker string, stooq_symbol string, fmp_symbol string, company_name string, "
                              "currency string")
    r = gold.build_dim_company(t).first()
    assert (r.ticker, r.company_name, r.listing_currency, r.fmp_symbol) == ("PKO", "PKO BP", "PLN", None)


def test_date_dimension_from_data(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 3, 2),)], "d date")
    cal = calendar.date_dimension_from(df, "d", pad_months=12)
    r = cal.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    assert (str(r.lo), str(r.hi)) == ("2023-02-28", "2025-03-02")
