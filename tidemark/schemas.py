"""Table schemas, canonical Gold column lists and fixed source values.

Grain and merge keys follow the data model: natural keys, no surrogate keys.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the source systems' contracts.
# ---------------------------------------------------------------------------
# Header of the daily OHLCV CSV export, in order.
EXPECTED_PRICE_CSV_HEADER = ["Date", "Open", "High", "Low", "Close", "Volume"]
# Maximum inclusive span (days) of one FX rates request.
FX_MAX_RANGE_DAYS = 367
# Envelope fields of a financial-statement record (everything else is a metric).
STATEMENT_ENVELOPE_COLUMNS = [
    "date", "symbol", "reportedCurrency", "cik", "filingDate", "acceptedDate",
    "fiscalYear", "period", "ticker", "source", "retrieved_at",
]
# Columns this library adds to statement rows before the unpivot.
STATEMENT_DERIVED_COLUMNS = ["statement_type", "period_type"]
# Country stamped on macro rows (a single-country statistics source today).
MACRO_COUNTRY = "PL"
# Default calendar bounds.
CALENDAR_DEFAULT_START = "2000-01-01"
CALENDAR_DEFAULT_END = "2035-12-31"
# Text dates in payloads.
PAYLOAD_DATE_FORMAT = "yyyy-MM-dd"
# Statement period marking an annual report, and the two period_type labels.
ANNUAL_PERIOD = "FY"
PERIOD_TYPE_ANNUAL = "annual"
PERIOD_TYPE_QUARTER = "quarter"
# camelCase -> snake_case: two regex passes (Java replacement syntax), then lower case.
CAMEL_PASS_1 = (r"(.)([A-Z][a-z]+)", "$1_$2")
CAMEL_PASS_2 = (r"([a-z0-9])([A-Z])", "$1_$2")
# Calendar name formats (full month name, full weekday name); weekdays are
# dayofweek 2..6 (1 = Sunday).
MONTH_NAME_FORMAT = "MMMM"
DAY_NAME_FORMAT = "EEEE"
TRADING_WEEKDAYS = (2, 6)
# ---------------------------------------------------------------------------

BRONZE_PRICES = StructType([
    StructField("ticker", StringType(), False),
    StructField("date", StringType(), False),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", LongType(), True),
    StructField("source", StringType(), False),
    StructField("retrieved_at", TimestampType(), False),
])

# CSV body as landed: text date, typed numbers. Columns named as in the header.
PRICE_CSV = StructType([
    StructField("Date", StringType(), True),
    StructField("Open", DoubleType(), True),
    StructField("High", DoubleType(), True),
    StructField("Low", DoubleType(), True),
    StructField("Close", DoubleType(), True),
    StructField("Volume", LongType(), True),
])

BRONZE_FX = StructType([
    StructField("currency_code", StringType(), False),
    StructField("effective_date", StringType(), False),
    StructField("mid_rate", DoubleType(), False),
    StructField("source", StringType(), False),
    StructField("retrieved_at", TimestampType(), False),
])

FX_PAYLOAD = ("table string, currency string, code string, "
              "rates array<struct<no:string,effectiveDate:string,mid:double>>")

BRONZE_MACRO = StructType([
    StructField("indicator_name", StringType(), False),
    StructField("variable_id", IntegerType(), False),
    StructField("year", IntegerType(), False),
    StructField("value", DoubleType(), True),
    StructField("unit", StringType(), True),
    StructField("source", StringType(), False),
    StructField("retrieved_at", TimestampType(), False),
])

MACRO_PAYLOAD = ("results array<struct<id:string,name:string,"
                 "values:array<struct<year:string,val:double,attrId:int>>>>")

TICKERS = StructType([
    StructField("ticker", StringType(), False),
    StructField("stooq_symbol", StringType(), True),
    StructField("fmp_symbol", StringType(), True),
    StructField("company_name", StringType(), True),
    StructField("currency", StringType(), True),
])

CURRENCIES = StructType([
    StructField("code", StringType(), False),
    StructField("name", StringType(), True),
])

MACRO_INDICATORS = StructType([
    StructField("name", StringType(), False),
    StructField("gus_variable_id", IntegerType(), False),
    StructField("unit", StringType(), True),
])

DIM_COMPANY = StructType([
    StructField("ticker", StringType(), False),
    StructField("company_name", StringType(), True),
    StructField("listing_currency", StringType(), True),
    StructField("fmp_symbol", StringType(), True),
])

DIM_DATE = StructType([
    StructField("date", DateType(), False),
    StructField("year", IntegerType(), False),
    StructField("quarter", IntegerType(), False),
    StructField("month", IntegerType(), False),
    StructField("month_name", StringType(), False),
    StructField("week_of_year", IntegerType(), False),
    StructField("day_of_week", IntegerType(), False),
    StructField("day_name", StringType(), False),
    StructField("is_trading_day_gpw", BooleanType(), False),
])

# Canonical Gold contracts (column order is part of the contract).
FACT_PRICES_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume",
                       "currency", "source", "retrieved_at"]
FACT_FUNDAMENTALS_COLUMNS = ["ticker", "period_end_date", "statement_type", "period_type",
                             "fiscal_year", "metric_name", "metric_value", "reported_currency",
                             "source", "retrieved_at"]
FACT_MACRO_COLUMNS = ["country", "reference_date", "indicator_name", "value", "unit",
                      "source", "retrieved_at"]
SILVER_FUNDAMENTALS_COLUMNS = ["ticker", "period_end_date", "statement_type", "period_type",
                               "fiscal_year", "reported_currency", "source", "retrieved_at",
                               "metric_name", "metric_value"]

# Natural keys per table (merge keys for upserts).
KEYS = {
    "silver_prices": ["ticker", "date"],
    "silver_fx_rates": ["currency_code", "effective_date"],
    # period_type is part of the key: a Q4 and an FY statement can share a date.
    "silver_fundamentals": ["ticker", "period_end_date", "statement_type", "period_type",
                            "metric_name"],
    "silver_macro": ["country", "indicator_name", "year"],
    "dim_company": ["ticker"],
    "dim_date": ["date"],
    "fact_prices": ["ticker", "date"],
    "fact_fundamentals": ["ticker", "period_end_date", "statement_type", "period_type",
                          "metric_name"],
    "fact_macro": ["country", "indicator_name", "reference_date"],
}

# Dedup keys in Bronze (before typing).
DEDUP_KEYS = {
    "prices": ["ticker", "date"],
    "fx_rates": ["currency_code", "effective_date"],
    "fundamentals": ["ticker", "date", "period", "statement_type"],
    "macro": ["indicator_name", "year"],
}
