import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import camel_to_snake
from tidemark.operators import dedup, reshape, standardize
from tidemark.operators.joins import DuplicateKeyError, add_currency_column
from tidemark.plans import catalog
from tidemark.schemas import BRONZE_FX, BRONZE_MACRO, BRONZE_PRICES

from conftest import T1, T2


def prices(spark, rows):
    return spark.createDataFrame(rows, BRONZE_PRICES)


def test_dedup_prices_latest_wins(spark):
    df = prices(spark, [("PKO", "2024-01-02", 1.0, 2.0, 0.5, 60.5, 10, "stooq", T1),
                        ("PKO", "2024-01-02", 1.0, 2.0, 0.5, 61.0, 10, "stooq", T2),
                        ("PZU", "2024-01-02", 1.0, 2.0, 0.5, 40.0, 10, "stooq", T1)])
    out = {(r.ticker, r.date): r.close for r in dedup.dedup_prices(df).collect()}
    assert out == {("PKO", "2024-01-02"): 61.0, ("PZU", "2024-01-02"): 40.0}


def test_dedup_tie_is_deterministic(spark):
    df = prices(spark, [("PKO", "2024-01-02", 1.0, 2.0, 0.5, 60.5, 10, "stooq", T1),
                        ("PKO", "2024-01-02", 1.0, 2.0, 0.5, 61.0, 10, "stooq", T1)])
    assert [r.close for r in dedup.dedup_prices(df).collect()] == [61.0]


def test_standardize_drops_bad_dates(spark):
    df = prices(spark, [("PKO", "2024-01-02", 1.0, 2.0, 0.5, 1.0, 1, "s", T1),
                        ("PKO", "not-a-date", 1.0, 2.0, 0.5, 1.0, 1, "s", T1),
                        ("PKO", "2024-1-3", 1.0, 2.0, 0.5, 1.0, 1, "s", T1)])
    out = standardize.standardize_prices(df)
    assert dict(out.dtypes)["date"] == "date"
    assert [str(r.date) for r in out.collect()] == ["2024-01-02"]


def test_fx_dedup_and_standardize(spark):
    df = spark.createDataFrame([("USD", "2024-01-02", 3.8117, "nbp", T1), ("USD", "2024-01-02", 3.95, "nbp", T2),
                                ("USD", "bad", 4.0, "nbp", T1)], BRONZE_FX)
    out = standardize.standardize_fx_rates(dedup.dedup_fx_rates(df)).collect()
    assert [(str(r.effective_date), r.mid_rate) for r in out] == [("2024-01-02", 3.95)]


def test_macro(spark):
    df = spark.createDataFrame([("cpi", 1, 2023, 114.4, "%", "gus", T1), ("cpi", 1, 2023, 114.5, "%", "gus", T2)],
                               BRONZE_MACRO)
    out = standardize.standardize_macro(dedup.dedup_macro(df)).collect()
    assert len(out) == 1 and out[0].value == 114.5
    assert str(out[0].reference_date) == "2023-12-31" and out[0].country == "PL"


def wide(spark, rows):
    cols = ("ticker string, date string, symbol string, reportedCurrency string, cik string, filingDate string, "
            "acceptedDate string, fiscalYear string, period string, statement_type string, source string, "
            "retrieved_at timestamp, totalAssets double, eps string")
    return spark.createDataFrame(rows, cols)


def test_fundamentals_chain(spark):
    rows = [("PKO", "2024-03-31", "PKO.WA", "PLN", "1", "f", "a", "2024", "Q1", "balance_sheet", "fmp", T1, 100.0, "x"),
            ("PKO", "2024-03-31", "PKO.WA", "PLN", "1", "f", "a", "2024", "Q1", "balance_sheet", "fmp", T2, 110.0, "NaN"),
            ("PKO", "2023-12-31", "PKO.WA", "PLN", "1", "f", "a", "2023", "FY", "balance_sheet", "fmp", T1, 90.0, "1.5"),
            ("PKO", "oops", "PKO.WA", "PLN", "1", "f", "a", "2023", "Q4", "balance_sheet", "fmp", T1, 1.0, "1")]
    std = standardize.standardize_fundamentals(dedup.dedup_fundamentals(wide(spark, rows)))
    types = {r.period: r.period_type for r in std.collect()}
    assert types == {"Q1": "quarter", "FY": "annual"}
    long = reshape.unpivot_statement_metrics(std)
    got = {(str(r.period_end_date), r.metric_name): r.metric_value for r in long.collect()}
    assert got[("2024-03-31", "total_assets")] == 110.0
    assert math.isnan(got[("2024-03-31", "eps")])           # 'NaN' text stays NaN
    assert got[("2023-12-31", "eps")] == 1.5
    assert ("2024-03-31", "symbol") not in got
    assert long.columns[:2] == ["ticker", "period_end_date"] and dict(long.dtypes)["fiscal_year"] == "int"


def test_text_metric_dropped_and_no_metric_raises(spark):
    df = spark.createDataFrame([("PKO", "txt")], "ticker string, brandName string")
    assert reshape.unpivot_numeric(df, ["ticker"], ["brandName"]).count() == 0
    with pytest.raises(reshape.NoMetricColumnsError):
        reshape.unpivot_numeric(df, ["ticker"], [])


def test_camel_to_snake(spark):
    df = spark.createDataFrame([("totalAssets",), ("EBITDARatio",), ("epsdiluted",), ("netIncomeRatio",)], "n string")
    out = [r.s for r in df.select(camel_to_snake(F.col("n")).alias("s")).collect()]
    assert out == ["total_assets", "ebitda_ratio", "epsdiluted", "net_income_ratio"]


def test_lookup_unknown_ticker_kept_and_duplicates_raise(spark):
    p = spark.createDataFrame([("PKO", 1.0), ("XYZ", 2.0)], "ticker string, close double")
    t = spark.createDataFrame([("PKO", "PLN")], "ticker string, currency string")
    out = {r.ticker: r.currency for r in add_currency_column(p, t).collect()}
    assert out == {"PKO": "PLN", "XYZ": None}
    dup = spark.createDataFrame([("PKO", "PLN"), ("PKO", "EUR")], "ticker string, currency string")
    with pytest.raises(DuplicateKeyError):
        add_currency_column(p, dup)


def test_merge_with_precedence(spark):
    a = spark.createDataFrame([("PKO", "d1", 1.0, T2)], "ticker string, date string, close double, retrieved_at timestamp")
    b = spark.createDataFrame([("PKO", "d1", 2.0, T1)], "ticker string, date string, close double, retrieved_at timestamp")
    out = dedup.merge_with_precedence([(a, 1), (b, 2)], ["ticker", "date"]).collect()
    assert [r.close for r in out] == [2.0]


def test_variant_metrics(spark):
    df = spark.createDataFrame([("PKO", '{"totalAssets": 10, "cash": 2.5, "name": "x", "EPSDiluted": 1}')],
                               "ticker string, p string")
    out = {r.metric_name: r.metric_value for r in reshape.variant_metrics(df, ["ticker"], "p").collect()}
    assert out == {"total_assets": 10.0, "cash": 2.5, "eps_diluted": 1.0}


def test_q4_and_fy_on_one_date_both_survive(spark):
    rows = [("PKO", "2023-12-31", "PKO.WA", "PLN", "1", "f", "a", "2023", "Q4", "balance_sheet", "fmp", T1, 100.0, "1"),
            ("PKO", "2023-12-31", "PKO.WA", "PLN", "1", "f", "a", "2023", "FY", "balance_sheet", "fmp", T1, 400.0, "4")]
    std = standardize.standardize_fundamentals(dedup.dedup_fundamentals(wide(spark, rows)))
    long = reshape.unpivot_statement_metrics(std).where("metric_name = 'total_assets'")
    got = {r.period_type: r.metric_value for r in long.collect()}
    assert got == {"quarter": 100.0, "annual": 400.0}   # period_type is part of the Silver key


def test_typed_fields_travel_once(spark):
    maps = [{"date": "2024-01-01", "a": "12", "b": "0.04", "other": "7"}, {"a": "012", "b": "1.50"}, {"a": None, "b": "-0.0"},
            {"b": "NaN"}, {"a": "x", "b": "1.0E7"}, {}, None]
    df = spark.createDataFrame([(k, m) for k, m in enumerate(maps)], "k int, payload map<string,string>")
    typed = df.withColumns({"ta": F.col("payload")["a"].try_cast("bigint"), "tb": F.col("payload")["b"].try_cast("double")})
    cols = {"a": F.col("ta"), "b": F.col("tb")}
    slim = typed.withColumn("payload", reshape.without_typed(F.col("payload"), cols))
    assert [r.payload for r in slim.orderBy("k").collect()] == [
        {"other": "7"}, {"a": "012", "b": "1.50"}, {"a": None}, {}, {"a": "x"}, {}, None]
    back = slim.withColumn("payload", reshape.with_typed(F.col("payload"), cols)).orderBy("k").collect()
    want = [m and {n: v for n, v in m.items() if n != "date"} for m in maps]
    assert [r.payload for r in back] == want


def test_variant_statements_carry_slim_rows(spark, tmp_path):
    rows = [(1, 7, 3, 1, 5.0, 10.5, 0.04, 0.02, "R", "O"), (2, 7, 4, 2, 6.0, -0.0, None, 0.0, "N", "O"),
            (3, 7, 4, 2, 6.0, 1e9, 0.1, 0.0, "R", "O"), (None, None, None, None, None, None, None, None, None, None)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    li = li.withColumn("l_shipdate", F.when(F.col("l_partkey").isNotNull(), F.lit("1998-05-06").cast("timestamp_ntz")))
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    out = catalog.variant_statements_silver(spark, str(tmp_path))
    wide = catalog.silver_fundamentals_lineitem(spark, str(tmp_path)).select(*out.columns)
    assert out.exceptAll(wide).count() == wide.exceptAll(out).count() == 0 < out.count()
    # what the rows carry to the deduplication beside their typed columns is an empty map
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "map_filter" in below and "record_pos" not in below.split("Generate")[0]
