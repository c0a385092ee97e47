"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] query [query ...]
(Queries that write tables or run streams do so while their plan is built.)
"""

from __future__ import annotations

import importlib.util
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from tidemark.session import get_session
    spark = get_session(cpus=8, shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    qs = entry.queries()
    for name in args or ["fact_prices_monthly"]:
        print(f"===== {name}")
        qs[name](spark, sf_dir).explain(mode="formatted")


if __name__ == "__main__":
    main()
