import datetime as dt

from tidemark.operators import quality as q


def ints(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def one(df):
    return df.first().asDict()


def test_counts(spark):
    a, b = ints(spark, 3), ints(spark, 2)
    assert one(q.compare_row_counts(a, a, exact=True))["passed"]
    r = one(q.compare_row_counts(a, b, exact=True))
    assert not r["passed"] and r["difference"] == 1
    assert one(q.compare_row_counts(a, b, exact=False))["passed"]
    r = one(q.compare_row_counts(b, a, exact=False))
    assert not r["passed"] and r["difference"] == -1
    r = one(q.compare_row_counts(a, ints(spark, 0), exact=False))
    assert r["passed"] and r["target_empty"]


def test_ranges(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 9),)], "d date")
    b = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 9),)], "period_end_date date")
    assert one(q.compare_range(a, a, "d", "d"))["passed"]
    assert not one(q.compare_range(a, b, "d", "period_end_date"))["passed"]
    text = spark.createDataFrame([("2024-01-01",), ("2024-01-09",), ("junk",)], "d string")
    r = one(q.compare_range(text, a, "d", "d"))
    assert r["passed"] and r["source_min"] == "2024-01-01"


def test_summary(spark):
    res = spark.createDataFrame([("a", True, 0), ("c", False, 2), ("b", False, 1)],
                                "check_name string, passed boolean, ordinal int")
    r = one(q.summarize(res))
    assert not r["all_passed"] and r["failed"] == ["b", "c"] and r["n_failed"] == 2
    ok = spark.createDataFrame([("a", True)], "check_name string, passed boolean")
    assert one(q.summarize(ok))["all_passed"] and one(q.summarize(ok))["failed"] == []


def test_suite(spark):
    tables = {"b": ints(spark, 5), "s": ints(spark, 4), "g": ints(spark, 4)}
    checks = [q.Check("bs", "count_loose", "b", "s"), q.Check("sg", "count_exact", "s", "g"),
              q.Check("sg_range", "range", "s", "g", "v", "v"), q.Check("bs_range", "range", "b", "s", "v", "v")]
    res = q.run_suite(tables, checks)
    assert [r.passed for r in res.orderBy("ordinal").collect()] == [True, True, True, False]
    assert one(q.summarize(res))["failed"] == ["bs_range"]


def test_orphans_nulls_rules(spark):
    f = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    r = one(q.orphan_counts([("f", f, dim, ["k"])]))
    assert (r["fact_rows"], r["orphan_rows"], r["passed"]) == (3, 2, False)
    nr = {x.column_name: x.null_rate for x in q.null_rates(f).collect()}
    assert abs(nr["k"] - 1 / 3) < 1e-12
    px = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5, 10), (3.0, 2.0, 0.5, 1.5, -1)],
                               "open double, high double, low double, close double, volume long")
    good, bad = q.split_valid(px, q.price_rules())
    assert good.count() == 1 and bad.first().violations == ["open_le_high", "volume_non_negative"]


def test_cross_source_diff(spark):
    a = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "k string, v double")
    b = spark.createDataFrame([("A", 1.005), ("B", 2.5), ("D", 4.0)], "k string, v double")
    got = {r.k: r.status for r in q.cross_source_diff(a, b, ["k"], "v", 0.01).collect()}
    assert got == {"A": "match", "B": "mismatch", "C": "only_a", "D": "only_b"}


def test_schema_drift(spark):
    df = spark.createDataFrame([("r1", '{"a": 1, "b": "x"}'), ("r2", '{"a": 1.5, "c": null}')], "batch string, p string")
    got = {(r.field, r.type_class, r.change) for r in q.schema_drift(df, "batch", "p", "r1", "r2").collect()}
    assert got == {("a", "double", "added"), ("c", "null", "added"), ("a", "integer", "removed"),
                   ("b", "string", "removed")}


def test_field_presence_drift(spark):
    df = spark.createDataFrame([("r1", 1.0, None, "x"), ("r1", 2.0, None, None), ("r2", 3.0, 5.0, None)],
                               "retrieved string, total double, goodwill double, note string")
    got = {(r.field, r.change) for r in q.field_presence_drift(df, "retrieved", "r1", "r2").collect()}
    assert got == {("goodwill", "added"), ("note", "removed")}
