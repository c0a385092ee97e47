"""Physical-plan properties that matter at scale (checked with explain())."""

import importlib.util
import os

import pytest

from conftest import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry_plans", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from tidemark.plans.catalog import QUERIES as OWN  # noqa: E402

QUERIES = {k: f for k, f in entry.queries().items() if k in OWN}


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, capsys, name):
    p = plan_of(QUERIES[name](spark, SMALL), capsys)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_dedup_limits_rows_before_the_shuffle(spark, capsys):
    p = plan_of(QUERIES["dedup_prices"](spark, SMALL), capsys)
    partial = p.find("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # the partial limit is evaluated below (printed after) the exchange
    assert p.rfind("Exchange") < p.rfind("WindowGroupLimit") and partial != -1


def test_lookup_is_broadcast_and_scan_is_pruned(spark, capsys):
    p = plan_of(QUERIES["fact_prices"](spark, SMALL), capsys)
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p
    events_scan = [ln for ln in p.splitlines() if ln.startswith("ReadSchema") and "user_id" in ln]
    assert events_scan and all("event_id" not in ln for ln in events_scan)


def test_asof_join_is_equi_join(spark, capsys):
    p = plan_of(QUERIES["asof_fx_convert"](spark, SMALL), capsys)
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p
    assert "LeftOuter" in p


def test_reconciliation_is_one_plan_with_partial_aggregates(spark, capsys):
    p = plan_of(QUERIES["recon_suite"](spark, SMALL), capsys)
    assert "partial_count" in p


def test_upsert_merge_reads_each_side_once(spark, capsys, scratch):
    import os

    from tidemark.sinks.upsert import merged
    path = os.path.join(scratch, "target")
    spark.range(5000).selectExpr("id AS k", "id * 2 AS v", "current_timestamp() AS at").write.parquet(path)
    target = spark.read.parquet(path)
    staged = os.path.join(scratch, "staged")
    spark.range(10).selectExpr("id AS k", "id * 3 AS v", "current_timestamp() AS at").write.parquet(staged)
    p = plan_of(merged(target, spark.read.parquet(staged), ["k"], newer_wins="at"), capsys)
    tree = p.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2 and "FullOuter" in p


def test_incremental_bronze_read_prunes_partitions(spark, capsys, scratch):
    import datetime as dt
    import os

    from tidemark.jobs.lake import Lake
    lake = Lake(os.path.join(scratch, "lake_prune"))
    for day in (1, 2, 3):
        df = spark.createDataFrame([("PKO", f"2024-01-0{day}", 1.0, dt.datetime(2024, 1, day, 6))],
                                   "ticker string, date string, close double, retrieved_at timestamp")
        lake.append_bronze(df, "bronze_stooq_prices")
    inc = lake.read_bronze(spark, "bronze_stooq_prices", since="2024-01-03")
    assert inc.count() == 1
    p = plan_of(inc, capsys)
    scan = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")]
    assert scan and "retrieved_date" in scan[0]
