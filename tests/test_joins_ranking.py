import datetime as dt
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.joins import asof_join, convert_currency
from tidemark.operators.ranking import grouped_rank


def test_asof_against_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    rates = [(c, base + dt.timedelta(days=d), round(rnd.uniform(1, 5), 4))
             for c in ("USD", "EUR") for d in sorted(rnd.sample(range(5, 60), 12))]
    facts = [(i, rnd.choice(["USD", "EUR", "GBP"]), base + dt.timedelta(days=rnd.randrange(0, 80))) for i in range(300)]
    r = spark.createDataFrame(rates, "c string, d date, rate double")
    f = spark.createDataFrame(facts, "id int, c string, d date")
    got = {x.id: x.rate for x in asof_join(f, r, ["c"], "d", "d", ["rate"]).collect()}
    for i, c, d in facts:
        cands = [(rd, v) for rc, rd, v in rates if rc == c and rd <= d]
        assert got[i] == (max(cands)[1] if cands else None), (i, c, d)


def test_convert_currency_base_is_one(spark):
    p = spark.createDataFrame([("PLN", dt.date(2024, 1, 5), 10.0), ("USD", dt.date(2024, 1, 5), 10.0)],
                              "currency string, date date, close double")
    r = spark.createDataFrame([("USD", dt.date(2024, 1, 3), 4.0)], "currency_code string, effective_date date, mid_rate double")
    out = {x.currency: x.close_pln for x in convert_currency(p, r).collect()}
    assert out == {"PLN": 10.0, "USD": 40.0}


def test_grouped_rank_matches_window_rank_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]),
             None if rnd.random() < 0.05 else float(rnd.randrange(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v double")
    expect = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    for parts in (1, 3, 16, None):
        got = grouped_rank(df, ["g"], "v", out_col="r", num_partitions=parts)
        a = pd.DataFrame(sorted(tuple(x) for x in got.select("id", "r").collect()))
        b = pd.DataFrame(sorted(tuple(x) for x in expect.select("id", "r").collect()))
        assert a.equals(b), parts


def test_asof_duplicate_rate_dates_are_deterministic(spark):
    r = spark.createDataFrame([("USD", dt.date(2024, 1, 1), 1.0), ("USD", dt.date(2024, 1, 1), 2.0),
                               ("USD", dt.date(2024, 1, 5), 3.0)], "c string, d date, rate double")
    f = spark.createDataFrame([(1, "USD", dt.date(2024, 1, 3)), (2, "USD", dt.date(2024, 1, 9))], "id int, c string, d date")
    got = {x.id: x.rate for x in asof_join(f, r, ["c"], "d", "d", ["rate"]).collect()}
    assert got == {1: 2.0, 2: 3.0}


def test_broadcast_bound_is_checked(spark):
    from tidemark.operators.joins import fits_broadcast
    assert fits_broadcast(spark.range(10))
    assert not fits_broadcast(spark.range(50), max_rows=40)
    assert not fits_broadcast(spark.range(50), max_bytes=100)  # the byte budget caps the rows


def test_grouped_rank_keeps_values_that_pandas_would_change(spark):
    big = 2 ** 60
    rows = [(1, "a", big + 1, float("nan")), (2, "a", big + 3, 1.0), (3, "a", None, None), (4, "a", big + 1, 1.0)]
    df = spark.createDataFrame(rows, "id int, g string, n bigint, x double")
    got = {r.id: (r.n, r.r) for r in grouped_rank(df, ["g"], "n", out_col="r").collect()}
    assert got == {1: (big + 1, 2), 2: (big + 3, 1), 3: (None, 4), 4: (big + 1, 2)}
    up = {r.id: r.r for r in grouped_rank(df, ["g"], "x", out_col="r", descending=False).collect()}
    assert up == {2: 1, 4: 1, 1: 3, 3: 4}  # NaN above the numbers, null last
    dec = df.selectExpr("id", "g", "cast(n as decimal(38,2)) as n")
    out = grouped_rank(dec, ["g"], "n", out_col="r")
    assert out.schema["n"].dataType.simpleString() == "decimal(38,2)"
    assert {r.id: r.r for r in out.collect()} == {1: 2, 2: 1, 3: 4, 4: 2}


def test_rewritten_lookup_is_checked_again(spark, scratch):
    import os

    import pytest

    from tidemark.operators.joins import DuplicateKeyError, lookup_left_join
    path = os.path.join(scratch, "lookup")
    facts = spark.createDataFrame([(1,)], "k int")
    spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1).write.parquet(path)
    assert lookup_left_join(facts, spark.read.parquet(path), "k").count() == 1
    spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string").coalesce(1).write.mode("overwrite").parquet(path)
    with pytest.raises(DuplicateKeyError):
        lookup_left_join(facts, spark.read.parquet(path), "k")
