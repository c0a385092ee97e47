"""Run registered queries in Spark and their DuckDB oracles; compare results.

Usage: python tools/compare.py [sf_dir] [name ...]
Compares column names, row counts and the multiset of normalized rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else f"{f:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


CANON = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
         "array<string>": "VARCHAR[]", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(s_types: dict, o_types: dict) -> list[str]:
    out = []
    for c, st in s_types.items():
        want = CANON.get(st, st.upper().replace(" ", ""))
        got = o_types.get(c, "?").replace(" ", "")
        if want.replace(" ", "") != got:
            out.append(f"{c}: spark {st} vs duckdb {o_types.get(c)}")
    return out


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rel.fetchall()
    o_types = dict(zip(o_cols, [str(t) for t in rel.types]))
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}")
    if len(s_rows) != len(o_rows):
        problems.append(f"rows differ: spark={len(s_rows)} oracle={len(o_rows)}")
    if not problems:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        oi = [o_cols.index(c) for c in order]
        sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
        oc = Counter(tuple(norm(r[i]) for i in oi) for r in o_rows)
        if sc != oc:
            only_s = list((sc - oc).elements())[:3]
            only_o = list((oc - sc).elements())[:3]
            problems.append(f"values differ ({order}): spark-only={only_s} oracle-only={only_o}")
    return problems, len(s_rows), t1 - t0, s_types, o_types


def main():
    import importlib.util
    spec = importlib.util.spec_from_file_location("spark_entry", __file__.rsplit("/tools/", 1)[0] + "/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    QUERIES, ORACLE_SQL = entry.queries(), entry.oracle_sql()
    args = sys.argv[1:]
    plain = "--plain" in args
    args = [a for a in args if a != "--plain"]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    if plain:  # a default session, as an outside caller would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        from tidemark.session import get_session
        spark = get_session(cpus=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE_SQL:
            df = QUERIES[n](spark, sf_dir)
            print(f"NOORACLE {n}: rows={df.count()}")
            continue
        try:
            problems, rows, secs, st, ot = compare(spark, con, n, QUERIES[n], ORACLE_SQL[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, rows, secs, st, ot = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1, 0, {}, {}
        tm = type_mismatches(st, ot) if st else []
        status = ("OK  " if not tm else "OK~ ") if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {n}: rows={rows} {secs:.1f}s")
        for p in problems:
            print("     ", p)
        for p in (tm if not problems else []):
            print("      type:", p)
        if problems and st:
            print("      types spark:", st)
            print("      types duck :", ot)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
