"""Skew check: one key holds ~40 % of the rows; how much does the busiest task get?

Runs keep-latest, grouped rank and the as-of join on events where every
click/view row is re-keyed to one hot key, with Spark's event log written to
a fresh scratch folder, then prints per stage the largest and the median
shuffle records read by one task and the longest task.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stage_stats(log_dir: str) -> dict[int, dict]:
    """Per stage: tasks, largest / median shuffle records read per task, longest task, job group."""
    tasks: dict[int, list] = {}
    group_of: dict[int, str] = {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        group_of[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append((rd, info["Finish Time"] - info["Launch Time"]))
    return {s: {"group": group_of.get(s, ""), "tasks": len(v), "max_read": max(r for r, _ in v),
                "median_read": statistics.median(r for r, _ in v), "max_ms": max(t for _, t in v)}
            for s, v in tasks.items() if any(r for r, _ in v)}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="tidemark-eventlog-", dir="/tmp")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logs).config("spark.eventLog.compress", "false")
             # keep all 16 reducers visible (at this size AQE would merge them into one task)
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.operators.dedup import keep_latest
    from tidemark.operators.joins import asof_join
    from tidemark.operators.ranking import grouped_rank
    from tidemark.plans import derive as d

    hot = F.col("source").isin("click", "view")
    prices = d.bronze_prices(spark, sf).withColumn("ticker", F.when(hot, F.lit("HOT")).otherwise(F.col("ticker"))) \
        .withColumn("date", F.when(hot, F.lit("2024-01-15")).otherwise(F.col("date")))
    n = prices.count()
    n_hot = prices.where(F.col("ticker") == "HOT").count()
    print(f"rows={n} hot_key_rows={n_hot} ({n_hot / n:.0%})")

    marks = []
    sc = spark.sparkContext
    for name, df in [
        ("keep_latest (hot ticker,date)", keep_latest(prices, ["ticker", "date"])),
        ("grouped_rank (hot group)", grouped_rank(prices, ["ticker"], "close", num_partitions=16)),
        ("asof_join (hot currency)", asof_join(
            prices.select("ticker", F.to_date(F.lit("2024-01-20")).alias("d"), F.lit("USD").alias("c")),
            prices.select(F.lit("USD").alias("c"), F.to_date(F.col("retrieved_at")).alias("d"),
                          F.col("close").alias("rate")).dropDuplicates(["c", "d"]),
            ["c"], "d", "d", ["rate"])),
    ]:
        sc.setJobGroup(name, name)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        marks.append((name, round(time.time() - t0, 2)))
    # contrast: the same dedup with Catalyst's window group limit switched off
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    name = "contrast: plain window, no group limit"
    sc.setJobGroup(name, name)
    t0 = time.time()
    keep_latest(prices, ["ticker", "date"]).write.format("noop").mode("overwrite").save()
    marks.append((name, round(time.time() - t0, 2)))
    spark.stop()
    stats = stage_stats(logs)
    for name, secs in marks:
        print(f"{name}: {secs}s")
    print("stage  tasks  max_records_read_by_one_task  median  longest_task_ms  query")
    for sid, v in sorted(stats.items()):
        print(f"{sid:5d} {v['tasks']:6d} {v['max_read']:12d} {v['median_read']:10.0f} {v['max_ms']:8d}  {v['group']}")
    print(f"event log: {logs}")


if __name__ == "__main__":
    main()
