"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed end to end through the ``noop`` sink (the whole plan
runs, nothing is collected to the driver), once, after an untimed warm-up pass
of all queries on the smallest tables. Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", str(cpus * 2))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    import importlib.util
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    qs = entry.queries()
    names = only or list(qs)

    # warm-up (JIT, class loading): every query once on the smallest tables, not
    # timed
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            try:
                qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - a failing query is reported by the timed run
                pass
    else:
        entry.entry(spark).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and continue
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"{name}: {times.get(name, 'FAILED')}", file=sys.stderr, flush=True)

    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
