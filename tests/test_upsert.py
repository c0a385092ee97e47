import os

import pytest

from tidemark.operators.joins import DuplicateKeyError
from tidemark.sinks import upsert as u


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_create_then_merge_and_idempotent(spark, scratch):
    path = os.path.join(scratch, "t")
    schema = "k int, v string"
    assert u.upsert(spark, spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["k"]) == 1
    src = spark.createDataFrame([(2, "B"), (3, "c")], schema)
    u.upsert(spark, src, path, ["k"])
    assert rows(u.read_current(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    u.upsert(spark, src, path, ["k"])
    assert rows(u.read_current(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(u.read_current(spark, path, version=1)) == [(1, "a"), (2, "b")]  # older snapshot kept
    assert u.vacuum(spark, path, keep=1) == [1, 2]


def test_null_key_never_matches(spark, scratch):
    path = os.path.join(scratch, "n")
    src = spark.createDataFrame([(None, "x")], "k int, v string")
    u.upsert(spark, src, path, ["k"])
    u.upsert(spark, src, path, ["k"])
    assert u.read_current(spark, path).count() == 2


def test_duplicate_source_key_raises(spark, scratch):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        u.upsert(spark, src, os.path.join(scratch, "d"), ["k"])


def test_uncommitted_version_ignored(spark, scratch):
    path = os.path.join(scratch, "c")
    u.upsert(spark, spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])
    os.makedirs(os.path.join(path, "v=00000002"))  # a crashed write: no _SUCCESS
    assert u.committed_versions(spark, path) == [1]
    assert u.upsert(spark, spark.createDataFrame([(2, "b")], "k int, v string"), path, ["k"]) == 2
    assert rows(u.read_current(spark, path)) == [(1, "a"), (2, "b")]


def test_partition_scoped_upsert(spark, scratch):
    path = os.path.join(scratch, "p")
    schema = "d string, k int, v string"
    first = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, "b"), ("d2", 3, "c")], schema)
    u.upsert_partitions(spark, first, path, ["d", "k"], ["d"])
    d2_files = sorted(os.listdir(os.path.join(path, "d=d2")))
    src = spark.createDataFrame([("d1", 2, "B"), ("d1", 4, "x")], schema)
    assert u.upsert_partitions(spark, src, path, ["d", "k"], ["d"]) == 1
    got = sorted(tuple(r) for r in u.read_partitioned(spark, path).select("d", "k", "v").collect())
    assert got == [("d1", 1, "a"), ("d1", 2, "B"), ("d1", 4, "x"), ("d2", 3, "c")]
    assert sorted(os.listdir(os.path.join(path, "d=d2"))) == d2_files  # untouched partition not rewritten
    u.upsert_partitions(spark, src, path, ["d", "k"], ["d"])           # idempotent
    assert u.read_partitioned(spark, path).count() == 4


def test_partition_upsert_recovers_interrupted_overwrite(spark, scratch):
    path, staged = os.path.join(scratch, "r"), os.path.join(scratch, "staged")
    schema = "d string, k int, v string"
    u.upsert_partitions(spark, spark.createDataFrame([("d1", 1, "a"), ("d2", 2, "b")], schema), path, ["d", "k"], ["d"])
    # simulate a crash after staging: d1's new content is staged, the table still has the old one
    spark.createDataFrame([("d1", 1, "A")], schema).write.parquet(staged)
    with open(os.path.join(path, "_tidemark_pending"), "w") as f:
        f.write(f"{staged}\nd\n")
    got = sorted(tuple(r) for r in u.read_partitioned(spark, path).select("d", "k", "v").collect())
    assert got == [("d1", 1, "A"), ("d2", 2, "b")]
    assert not os.path.exists(os.path.join(path, "_tidemark_pending"))


def test_partition_columns_must_be_keys(spark, scratch):
    with pytest.raises(ValueError):
        u.upsert_partitions(spark, spark.createDataFrame([("d", 1)], "d string, k int"), os.path.join(scratch, "x"),
                            ["k"], ["d"])


def test_newer_wins(spark, scratch):
    import datetime as dt
    path = os.path.join(scratch, "nw")
    schema = "k int, v string, at timestamp"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    u.upsert(spark, spark.createDataFrame([(1, "new", t2), (2, "old", t1)], schema), path, ["k"])
    src = spark.createDataFrame([(1, "stale", t1), (2, "fresh", t2), (3, "ins", t1)], schema)
    u.upsert(spark, src, path, ["k"], newer_wins="at")
    assert rows(u.read_current(spark, path).select("k", "v")) == [(1, "new"), (2, "fresh"), (3, "ins")]


def test_merge_into_catalog_creates_then_needs_row_level_format(spark):
    from tidemark.sinks.upsert import merge_into_catalog
    src = spark.createDataFrame([(1, "a")], "k int, v string")
    spark.sql("DROP TABLE IF EXISTS tm_merge_t")
    merge_into_catalog(src, "tm_merge_t", ["k"])               # first run creates the table
    assert spark.table("tm_merge_t").count() == 1
    with pytest.raises(Exception) as e:                       # plain Parquet has no MERGE
        merge_into_catalog(spark.createDataFrame([(1, "b")], "k int, v string"), "tm_merge_t", ["k"])
    assert "UNSUPPORTED_FEATURE.TABLE_OPERATION" in str(e.value)


def test_compact_partitions_keeps_rows_and_reduces_files(spark, scratch):
    path = os.path.join(scratch, "bronze")
    for i in range(6):  # six small appends into one day
        spark.createDataFrame([(i, "2024-01-02")], "k int, d string").write.mode("append").partitionBy("d").parquet(path)
    spark.createDataFrame([(99, "2024-01-03")], "k int, d string").write.mode("append").partitionBy("d").parquet(path)
    before = [f for f in os.listdir(os.path.join(path, "d=2024-01-02")) if f.endswith(".parquet")]
    other = sorted(os.listdir(os.path.join(path, "d=2024-01-03")))
    assert u.compact_partitions(spark, path, ["d"], "d = '2024-01-02'") == 6
    after = [f for f in os.listdir(os.path.join(path, "d=2024-01-02")) if f.endswith(".parquet")]
    assert len(after) < len(before)
    assert sorted(os.listdir(os.path.join(path, "d=2024-01-03"))) == other
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 5, 99]


def test_upsert_additive_schema_evolution(spark, scratch):
    path = os.path.join(scratch, "evo")
    u.upsert(spark, spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])
    u.upsert(spark, spark.createDataFrame([(2, "b", 7)], "k int, v string, extra int"), path, ["k"])
    assert rows(u.read_current(spark, path).select("k", "v", "extra")) == [(1, "a", None), (2, "b", 7)]
    with pytest.raises(ValueError):
        u.upsert(spark, spark.createDataFrame([(3,)], "k int"), path, ["k"])


def test_partitioned_upsert_schema_evolution(spark, scratch):
    path = os.path.join(scratch, "pevo")
    u.upsert_partitions(spark, spark.createDataFrame([("d1", 1, "a"), ("d2", 2, "b")], "d string, k int, v string"),
                        path, ["d", "k"], ["d"])
    u.upsert_partitions(spark, spark.createDataFrame([("d1", 3, "c", 9)], "d string, k int, v string, extra int"),
                        path, ["d", "k"], ["d"])
    got = sorted(tuple(r) for r in u.read_partitioned(spark, path).select("d", "k", "v", "extra").collect())
    assert got == [("d1", 1, "a", None), ("d1", 3, "c", 9), ("d2", 2, "b", None)]


def test_many_touched_partitions(spark, scratch):
    path = os.path.join(scratch, "many")
    first = spark.range(1200).selectExpr("cast(id % 1100 as int) AS d", "cast(id as int) AS k", "'a' AS v")
    u.upsert_partitions(spark, first, path, ["d", "k"], ["d"])
    second = spark.range(1150).selectExpr("cast(id % 1100 as int) AS d", "cast(id as int) AS k", "'b' AS v")
    assert u.upsert_partitions(spark, second, path, ["d", "k"], ["d"]) == 1100
    got = u.read_partitioned(spark, path).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {"b": 1150, "a": 50}


def test_compaction_keeps_evolved_columns(spark, scratch):
    path = os.path.join(scratch, "evolved")
    spark.createDataFrame([(1, "d1")], "k int, d string").write.mode("append").partitionBy("d").parquet(path)
    spark.createDataFrame([(2, 7.5, "d1")], "k int, adj double, d string").write.mode("append").partitionBy("d").parquet(path)
    u.compact_partitions(spark, path, ["d"])
    assert rows(u.read_partitioned(spark, path).select("k", "adj")) == [(1, None), (2, 7.5)]


def test_missing_success_marker_is_no_empty_table(spark, scratch):
    path = os.path.join(scratch, "nomark")
    schema = "d string, k int, v string"
    u.upsert_partitions(spark, spark.createDataFrame([("d1", i, "a") for i in range(20)], schema), path, ["d", "k"], ["d"])
    if os.path.exists(os.path.join(path, "_SUCCESS")):  # committers differ in writing it
        os.remove(os.path.join(path, "_SUCCESS"))
    u.upsert_partitions(spark, spark.createDataFrame([("d1", 3, "b")], schema), path, ["d", "k"], ["d"])
    assert u.read_partitioned(spark, path).count() == 20
    snap = os.path.join(scratch, "snap")
    u.upsert(spark, spark.createDataFrame([(1, "a")], "k int, v string"), snap, ["k"])
    os.remove(os.path.join(snap, "v=00000001", "_SUCCESS"))
    u.upsert(spark, spark.createDataFrame([(2, "b")], "k int, v string"), snap, ["k"])
    assert rows(u.read_current(spark, snap)) == [(1, "a"), (2, "b")]


def test_vacuum_refuses_to_delete_the_table(spark, scratch):
    path = os.path.join(scratch, "vac")
    u.upsert(spark, spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])
    with pytest.raises(ValueError):
        u.vacuum(spark, path, keep=0)


def test_append_stores_one_type_per_column(spark, scratch):
    from tidemark.sinks.tables import SchemaDriftError, append, read_appended
    path = os.path.join(scratch, "drift")
    metrics = ["revenue", "goodwill"]
    append(spark.createDataFrame([("a", 1)], "t string, revenue bigint"), path, numbers_as_double=metrics)
    append(spark.createDataFrame([("b", 2.5)], "t string, revenue double"), path, numbers_as_double=metrics)
    append(spark.createDataFrame([("c", None, 4)], "t string, revenue string, goodwill int"), path, numbers_as_double=metrics)
    got = read_appended(spark, path)
    assert got.schema["revenue"].dataType.simpleString() == "double"
    assert rows(got.select("t", "revenue", "goodwill")) == [("a", 1.0, None), ("b", 2.5, None), ("c", None, 4.0)]
    with pytest.raises(SchemaDriftError):
        append(spark.createDataFrame([("d", "text")], "t string, revenue string"), path)
    assert read_appended(spark, path).count() == 3
