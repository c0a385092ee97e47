"""Incremental landing, content reconciliation, maintained rollups, as-of and band joins, quantiles, stateful streams."""

import datetime as dt
import json
import os
import random
from collections import Counter, defaultdict
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.jobs.lake import Lake
from tidemark.jobs.landing import ingest_new_fx, ingest_new_prices, read_landed
from tidemark.jobs.rollups import merge_facts, read_rollup, refresh_rollup
from tidemark.operators.asof import asof_join_sorted
from tidemark.operators.band import nearest_match
from tidemark.operators.deltas import WEIGHT, apply_deltas, change_images, rollup_deltas
from tidemark.operators.joins import DuplicateKeyError
from tidemark.operators.ranking import grouped_quantiles
from tidemark.operators.reconcile import FAN, LEVELS, compare_content, content_diff, content_tree, differing_leaves
from tidemark.sinks.upsert import read_current
from tidemark.sources.landed import EmptyBatchError, batch_status, require_batches
from tidemark.streaming.joins import convert_ticks, first_deliveries, start_stateful_append

HEAD = "Date,Open,High,Low,Close,Volume"


def retrieved():
    return F.to_timestamp_ntz(F.lit("2024-05-01 06:00:00"))


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text)


# ---- incremental landing

@pytest.fixture
def symbols(spark):
    return spark.createDataFrame([("AAA", "a"), ("BBB", "b"), ("CCC", "c")], "ticker string, stooq_symbol string")


def test_each_landed_row_once(spark, scratch, symbols):
    landing, lake = f"{scratch}/in", Lake(f"{scratch}/lake")
    table = lake.path("bronze_stooq_prices_landed")

    def run():
        return ingest_new_prices(spark, lake, landing, symbols, retrieved())

    def dates(ticker):
        return sorted(r.date for r in read_landed(spark, table).where(F.col("ticker") == ticker).collect())

    put(landing, "a.csv", f"{HEAD}\n2024-01-02,1,2,0.5,1.5,10\n\n2024-01-03,1,2,0.5,1.5,20\n2024-01-04,1\n")
    assert run() == 1 and dates("AAA") == ["2024-01-02", "2024-01-03"]
    assert run() == 0 and dates("AAA") == ["2024-01-02", "2024-01-03"]
    put(landing, "b.csv", f"{HEAD}\r\n2024-01-02,1,2,0.5,1.5,10\r\n,1,2,0.5,1.5,10\r\n")
    put(landing, "z.csv", f"{HEAD}\n2024-01-02,1,2,0.5,1.5,10\n")
    put(landing, "c.csv", "Date;Open\n")
    put(landing, "c2.csv", "")
    assert run() == 1 and dates("BBB") == ["2024-01-02"]
    # a crash between the write and the checkpoint: the batch runs again and replaces what it wrote
    commits = f"{table}/_landing_checkpoint/commits"
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    put(landing, "d.csv", f"{HEAD}\n2024-01-09,1,2,0.5,1.5,10\n")
    run()
    assert dates("AAA") == ["2024-01-02", "2024-01-03"] and dates("BBB") == ["2024-01-02"]
    reasons = Counter(r.reject_reason for r in read_landed(spark, table, rejected=True).collect())
    assert reasons == {"row does not parse": 2, "unknown symbol": 2, "header": 1}  # an empty file has no row
    volume = {r.date: r.volume for r in read_landed(spark, table).where("ticker = 'AAA'").collect()}
    assert volume == {"2024-01-02": 10, "2024-01-03": 20}


def test_rates_land_once(spark, scratch):
    landing, lake = f"{scratch}/in", Lake(f"{scratch}/lake")
    put(landing, "1.json", json.dumps({"code": "EUR", "rates": [{"effectiveDate": "2024-02-05", "mid": 4.31},
                                                               {"effectiveDate": "2024-02-06", "mid": -1.0}]}))
    put(landing, "2.json", "<html>")
    for _ in range(2):
        ingest_new_fx(spark, lake, landing, retrieved())
    put(landing, "3.json", json.dumps({"code": "USD", "rates": [{"effectiveDate": "2024-02-05", "mid": 3.97}]}))
    ingest_new_fx(spark, lake, landing, retrieved())
    table = lake.path("bronze_nbp_fx_rates_landed")
    assert sorted((r.currency_code, r.mid_rate) for r in read_landed(spark, table).collect()) == [("EUR", 4.31), ("USD", 3.97)]
    bad = sorted(r.reject_reason.split(":")[0] for r in read_landed(spark, table, rejected=True).collect())
    assert bad == ["html", "rules"]


def test_batches_judged_in_one_aggregate(spark):
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", None), (None, 3)], "item string, v int")
    names = spark.createDataFrame([("x",), ("y",), ("z",), ("x",)], "item string")
    status = batch_status(rows, "item", names, F.col("v") > 0)
    assert sorted(map(tuple, status.collect())) == [("x", 2, 2, False), ("y", 1, 0, True), ("z", 0, 0, True)]
    with pytest.raises(EmptyBatchError, match="y, z"):
        require_batches(status, "item")
    require_batches(batch_status(rows, "item", names.where("item = 'x'").limit(1), None).where("item = 'x'"), "item")


# ---- content reconciliation

SCHEMA = "a string, b int, x double, y string, z string"
COLUMNS = ["a", "b", "x", "y", "z"]


def random_rows(rng, n):
    return [(rng.choice([None, "k1", "k2", "k3"]), rng.choice([None, *range(40)]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]),
             rng.choice([None, "", "t"]), rng.choice([None, "t", "u"])) for _ in range(n)]


def same(v):
    return "nan" if v != v else 0.0 if v == 0.0 and isinstance(v, float) else v


def brute_diff(s, t):
    groups = [defaultdict(Counter), defaultdict(Counter)]
    for g, rows in zip(groups, (s, t)):
        for r in rows:
            g[r[:2]][tuple(map(same, r[2:]))] += 1
    out = {}
    for k in groups[0].keys() | groups[1].keys():
        x, y = (g.get(k, Counter()) for g in groups)
        if x != y:
            names = None
            if sum(x.values()) == sum(y.values()) == 1:
                names = ",".join(c for c, p, q in zip(COLUMNS[2:], *x, *y) if p != q)
            out[k] = ("missing" if not y else "extra" if not x else "changed", sum(x.values()), sum(y.values()), names)
    return out


def test_content_diff_equals_brute_force(spark):
    rng = random.Random(2)
    for n in (0, 60, 300):
        s = random_rows(rng, n)
        t = [r for r in s if rng.random() > 0.1] + random_rows(rng, n // 10)
        t = [(*r[:3], r[4], r[3]) if rng.random() < 0.1 else r for r in t]  # values that change places
        rng.shuffle(t)
        out = content_diff(spark.createDataFrame(s, SCHEMA), spark.createDataFrame(t, SCHEMA), ["a", "b"], COLUMNS).collect()
        assert {(r.a, r.b): tuple(r)[2:] for r in out} == brute_diff(s, t)
        assert len(out) == len(brute_diff(s, t))


def test_only_differing_leaves_are_opened(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    other = df.withColumn("v", F.when(F.col("k").isin(17, 4000), -1).otherwise(F.col("v")))
    tree = content_tree(df, ["k"], ["k", "v"])
    counts = {r.level: (r.n, r["count"]) for r in tree.groupBy("level").agg(F.sum("n").alias("n"), F.count("*").alias("count")).collect()}
    assert counts[0] == (5000, 1) and all(n == 5000 for n, _ in counts.values()) and len(counts) == LEVELS + 1
    assert counts[1][1] <= FAN and counts[LEVELS][1] <= 5000
    assert differing_leaves(tree, content_tree(df.repartition(5), ["k"], ["k", "v"])).count() == 0
    assert differing_leaves(tree, content_tree(other, ["k"], ["k", "v"])).count() == 2
    assert differing_leaves(tree, content_tree(df.limit(0), ["k"], ["k", "v"])).count() == counts[LEVELS][1]


def test_content_check_row(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("v"))
    good = compare_content(df, df, ["id"], ["id", "v"]).first()
    assert good.passed and (good.source_count, good.target_count, good.difference) == (100, 100, 0)
    bad = compare_content(df, df.withColumn("v", F.when(F.col("id") == 5, 2.0).otherwise(F.col("v"))), ["id"], ["id", "v"]).first()
    assert not bad.passed and bad.difference == 1
    none = compare_content(df.limit(0), df.limit(0), ["id"], ["id", "v"]).first()
    assert none.passed and none.target_empty


# ---- maintained rollups

def groups():
    return {"g": F.col("g"), "month": F.month("day")}


def random_increment(rng, n):
    keys = rng.sample(range(60), n)
    return [(k, rng.choice(["x", "y", None]), dt.date(2024, rng.choice([1, 2]), 1 + k % 28), Decimal(rng.randrange(-500, 500)) / 100
             if rng.random() > 0.1 else None, rng.randrange(5)) for k in keys]


FACTS = "k int, g string, day date, amount decimal(12,2), version int"


@pytest.mark.parametrize("newer_wins", [None, "version"])
def test_rollup_equals_rebuild(spark, scratch, newer_wins):
    rng = random.Random(4)
    facts, rollup = f"{scratch}/facts", f"{scratch}/rollup"
    for step in range(4):
        merge_facts(spark, spark.createDataFrame(random_increment(rng, 30 if step == 0 else 12), FACTS), facts, ["k"], newer_wins)
        if step == 1:
            continue  # two merges are taken by one refresh
        assert refresh_rollup(spark, facts, rollup, groups(), {"total": F.col("amount")}) == (2 if step == 2 else 1)
        assert refresh_rollup(spark, facts, rollup, groups(), {"total": F.col("amount")}) == 0
        want = read_current(spark, facts).groupBy("g", F.month("day").alias("month")).agg(
            F.count("*").alias("n_rows"), F.coalesce(F.sum("amount"), F.lit(0)).alias("total"))
        got = read_rollup(spark, rollup)
        assert sorted(map(str, (tuple(r) for r in got.select("g", "month", "n_rows", F.col("total").cast("decimal(20,2)")).collect()))) == sorted(
            map(str, (tuple(r) for r in want.select("g", "month", "n_rows", F.col("total").cast("decimal(20,2)")).collect())))


def test_images(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "k int, g string, v int")
    source = spark.createDataFrame([(2, "c", 2), (3, "b", 3), (4, "a", 9), (None, "a", 1)], "k int, g string, v int")
    images = change_images(target, source, ["k"])
    assert sorted(((r.k or 0), r.g, r.v, r[WEIGHT]) for r in images.collect()) == [
        (0, "a", 1, 1), (2, "a", 2, -1), (2, "c", 2, 1), (4, "a", 9, 1)]
    deltas = rollup_deltas(images, {"g": F.col("g")}, {"v": F.col("v")})
    old = target.groupBy("g").agg(F.count("*").alias("n_rows"), F.sum("v").alias("v"))
    assert sorted(tuple(r) for r in apply_deltas(old, deltas, ["g"], ["v"]).collect()) == [("a", 3, 11), ("c", 1, 2)]
    with pytest.raises(DuplicateKeyError):
        change_images(target, source.unionByName(source), ["k"])


# ---- as-of join

def brute_asof(left, right, tolerance=None):
    out = []
    for k, t, p in left:
        best = None
        for k2, t2, v in right:
            if k is not None and t is not None and k2 == k and t2 is not None and t2 <= t and (tolerance is None or t2 >= t - tolerance):
                best = max(best, (t2, v is not None, v)) if best else (t2, v is not None, v)
        out.append((k, t, p, best[2] if best else None, best[0] if best else None))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_asof_equals_brute_force(spark, partitions):
    rng = random.Random(partitions)
    base = dt.datetime(2024, 1, 1)

    def rows(n, what):
        return [(rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice([None] + [base + dt.timedelta(minutes=rng.randrange(300))] * 9),
                 what(i)) for i in range(n)]
    left, right = rows(160, lambda i: i % 40), rows(90, lambda i: rng.choice([None, float(i)]))
    left += left[:10]
    one = spark.createDataFrame(left, "k string, ts timestamp_ntz, p int")
    two = spark.createDataFrame(right, "k string, at timestamp_ntz, v double")
    key = lambda r: tuple((x is not None, x) for x in r)
    out = asof_join_sorted(one, two, ["k"], "ts", "at", ["v"], partitions=partitions)
    assert out.columns == ["k", "ts", "p", "v", "matched_at"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(brute_asof(left, right), key=key)
    near = asof_join_sorted(one, two, ["k"], "ts", "at", ["v"], tolerance="20 minutes", partitions=partitions)
    assert sorted(map(tuple, near.collect()), key=key) == sorted(brute_asof(left, right, dt.timedelta(minutes=20)), key=key)
    assert asof_join_sorted(one.limit(0), two, ["k"], "ts", "at", ["v"]).count() == 0
    assert asof_join_sorted(one, two.limit(0), ["k"], "ts", "at", ["v"]).where("v is not null").count() == 0


def test_asof_spreads_a_hot_key(spark):
    one = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    two = spark.range(0, 4000, 7).select(F.lit("hot").alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    out = asof_join_sorted(one, two, ["k"], "t", "at", ["v"], partitions=8)
    assert out.where("v != t - t % 7").count() == 0 and out.count() == 4000
    laid = out.inputFiles()
    assert len(laid) >= 6  # the key lies in many range partitions


# ---- band join

def test_nearest_match_equals_brute_force(spark):
    rng = random.Random(8)
    day = dt.date(2024, 3, 1)

    def side():
        got = {(rng.choice(["hot", "hot", "b"]), day + dt.timedelta(days=rng.randrange(60))): rng.choice([None, 1.0, 1.2, 3.0]) for _ in range(60)}
        return [(k, d, v) for (k, d), v in got.items()] + [(None, day, 1.0), ("b", None, 2.0)]
    for days in (0, 1, 3):
        a, b = side(), side()
        want, met = [], set()
        for k, d, v in a:
            near = [(abs((d2 - d).days), d2, v2) for k2, d2, v2 in b if k is not None and d and k2 == k and d2 and abs((d2 - d).days) <= days]
            met |= {(k, x[1]) for x in near}
            best = min(near, key=lambda x: x[:2], default=None)
            status = "only_a" if not best else "match" if None not in (v, best[2]) and abs(v - best[2]) <= 0.25 else "mismatch"
            want.append((k, d, v, best[1] if best else None, best[2] if best else None, status))
        want += [(k, None, None, d, v, "only_b") for k, d, v in b if (k, d) not in met]
        schema = "k string, d date, v double"
        out = nearest_match(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], "d", "v", days, 0.25)
        key = lambda r: tuple((x is not None, x) for x in r)
        assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    with pytest.raises(DuplicateKeyError):
        nearest_match(spark.createDataFrame([("x", day, 1.0)] * 2, schema), spark.createDataFrame(a, schema), ["k"], "d", "v", 1, 0.1)


# ---- exact quantiles

def test_quantiles_equal_duckdb(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, 7.0, 7.0, rng.random() * 50])) for _ in range(500)] + [("none", None)]
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    out = grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", qs, num_partitions=7)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (g VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = con.sql(f"SELECT g, count(v), {', '.join(f'quantile_disc(v, {q})' for q in qs)} FROM t GROUP BY g").fetchall()
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


# ---- stateful streams

def stream_of(spark, folder, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_redelivered_and_late_events(spark, scratch):
    batches = [[(1, at(1)), (2, at(1, 5)), (1, at(1))], [(2, at(1, 5)), (3, at(9))], [(1, at(1)), (5, at(10)), (None, at(10))],
               [(None, at(10)), (4, at(2)), (5, at(10))]]
    stream = stream_of(spark, f"{scratch}/in", batches, "id int, ts timestamp")
    start_stateful_append(first_deliveries(stream, ["id"], watermark="2 days"), f"{scratch}/out", f"{scratch}/cp", 2).awaitTermination()
    # 4 is first delivered eight days behind the newest event: dropped as late, like the redelivery of 1
    assert sorted((r.id or 0) for r in spark.read.parquet(f"{scratch}/out").collect()) == [0, 1, 2, 3, 5]


def test_stream_conversion_equals_batch(spark, scratch):
    ticks = [[(1, "EUR", at(1, 3), 2.0), (2, "EUR", at(2, 3), 2.0)], [(3, "USD", at(2, 4), 1.0), (4, "EUR", at(3), 5.0)],
             [(5, "EUR", at(2, 23), 1.0), (6, "CHF", at(4), 1.0)]]
    rates = [[("EUR", at(1), 4.0)], [("EUR", at(2), 4.5), ("USD", at(2), 3.5)], [("EUR", at(3), 5.0)]]
    s1, s2 = "id int, currency string, ts timestamp, price double", "currency string, valid_from timestamp, rate double"
    out = convert_ticks(stream_of(spark, f"{scratch}/t", ticks, s1), stream_of(spark, f"{scratch}/r", rates, s2),
                        tick_delay="3 days", rate_delay="3 days")
    start_stateful_append(out, f"{scratch}/out", f"{scratch}/cp", 2).awaitTermination()
    batch = convert_ticks(spark.createDataFrame(sum(ticks, []), s1), spark.createDataFrame(sum(rates, []), s2))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").select("id", "rate", "converted").collect())
    assert got == sorted(tuple(r) for r in batch.select("id", "rate", "converted").collect())
    assert got == [(1, 4.0, 8.0), (2, 4.5, 9.0), (3, 3.5, 3.5), (4, 5.0, 25.0), (5, 4.5, 4.5)]
    left = convert_ticks(spark.createDataFrame(sum(ticks, []), s1), spark.createDataFrame(sum(rates, []), s2), how="left")
    assert [r.id for r in left.where("rate is null").collect()] == [6]


# ---- bucketed merge

def test_bucketed_merge_moves_the_source_only(spark):
    import uuid

    from tidemark.sinks.bucketed import merge_bucketed, merge_plan
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    target = spark.createDataFrame([(k, "a", k) for k in range(50)] + [(None, "n", 0)], "k int, g string, v int")
    source = spark.createDataFrame([(k, "b", -k) for k in range(40, 60)] + [(None, "m", 1)], "k int, g string, v int")
    merge_bucketed(spark, target, name, ["k"], buckets=8)
    plan = merge_plan(spark, source, name, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FullOuter" in plan  # the source's
    merge_bucketed(spark, source, name, ["k"])
    merge_bucketed(spark, source, name, ["k"], newer_wins="v")
    want = {k: ("b", -k) if k >= 40 else ("a", k) for k in range(60)}
    rows = spark.table(name).collect()
    assert {r.k: (r.g, r.v) for r in rows if r.k is not None} == want
    assert sorted(r.g for r in rows if r.k is None) == ["m", "m", "n"]  # null keys match nothing
    merge_bucketed(spark, source.where("k = 59").withColumn("w", F.lit(1.5)), name, ["k"])
    assert spark.table(name).where("w = 1.5").count() == 1 and spark.table(name).columns == ["k", "g", "v", "w"]
    with pytest.raises(DuplicateKeyError):
        merge_bucketed(spark, source.unionByName(source), name, ["k"])


# ---- nested drift

def test_nested_drift(spark):
    from tidemark.operators.nested import nested_drift, type_paths
    rows = [("a", '{"x":1,"y":{"z":[{"p":1},{"q":"t"}]},"gone":null}'), ("a", '{"x":2.5}'), ("a", "no json"), ("a", None),
            ("b", '{"x":"1","y":{"z":[{"p":1,"q":"t","r":[true]}],"odd.name":1}}'), ("c", '{"x":1}')]
    df = spark.createDataFrame(rows, "batch string, payload string")
    got = sorted(map(tuple, nested_drift(df, "batch", "payload", "a", "b").collect()))
    assert got == [("$.gone", "null", None, "removed"), ("$.x", "number", "string", "retyped"),
                   ("$.y.odd.name", None, "number", "added"), ("$.y.z[].r", None, "array", "added"),
                   ("$.y.z[].r[]", None, "boolean", "added")]
    assert nested_drift(df, "batch", "payload", "a", "a").count() == 0
    assert {r.change for r in nested_drift(df, "batch", "payload", "none", "c").collect()} == {"added"}
    kind = spark.sql("""select schema_of_variant(parse_json('{"a<b":{"c,d":[[1]]},"e`f":"x"}')) as t""").first().t
    assert dict(type_paths(kind)) == {"$": "object", "$.a<b": "object", "$.a<b.c,d": "array", "$.a<b.c,d[]": "array",
                                      "$.a<b.c,d[][]": "number", "$.e`f": "string"}
    deep = nested_drift(spark.createDataFrame([("a", '{"u":{"v":1}}'), ("b", '{"u":[{"v":1}]}')], "batch string, payload string"),
                        "batch", "payload", "a", "b")
    assert [tuple(r) for r in deep.collect()] == [("$.u", "object", "array", "retyped")]


# ---- jobs

def test_content_job_and_maintained_facts(spark, scratch):
    from tidemark.jobs.quality import run_content_reconciliation
    from tidemark.jobs.rollups import PRICES_MONTHLY, advance_fact_prices
    from tidemark.operators import gold
    from tidemark.operators.quality import ReconciliationError
    from tidemark.schemas import KEYS
    from tidemark.sinks.tables import read_appended
    lake = Lake(f"{scratch}/lake")

    def prices(rows):
        return spark.createDataFrame([(t, d, c, c, c, c, 10, "PLN", "s", r) for t, d, c, r in rows], "ticker string, date date, open double, "
                                     "high double, low double, close double, volume long, currency string, source string, retrieved_at timestamp")
    days = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    lake.upsert(spark, prices([("A", d, 1.5, at(1)) for d in days]), "silver_prices", KEYS["silver_prices"])
    gold_macro = spark.createDataFrame([("PL", dt.date(2023, 12, 31), "cpi", 1.0, "%", "gus", at(1))],
                                       "country string, reference_date date, indicator_name string, value double, unit string, "
                                       "source string, retrieved_at timestamp")
    lake.upsert(spark, gold_macro.withColumn("year", F.lit(2023)), "silver_macro", KEYS["silver_macro"])
    lake.upsert(spark, gold_macro, "fact_macro", KEYS["fact_macro"])
    fundamentals = spark.createDataFrame([("A", dt.date(2023, 12, 31), "bs", "annual", 2023, "PLN", "fmp", at(1), "assets", 5.0)],
                                         "ticker string, period_end_date date, statement_type string, period_type string, fiscal_year int, "
                                         "reported_currency string, source string, retrieved_at timestamp, metric_name string, metric_value double")
    lake.upsert(spark, fundamentals, "silver_fundamentals", KEYS["silver_fundamentals"])
    lake.upsert(spark, gold.build_fact_fundamentals(fundamentals), "fact_fundamentals", KEYS["fact_fundamentals"])

    def monthly():
        return sorted((r.month, r.n_rows, float(r.sum_close)) for r in read_rollup(spark, lake.path(PRICES_MONTHLY)).collect())
    assert advance_fact_prices(spark, lake) == 1 and monthly() == [(1, 2, 3.0), (2, 1, 1.5)]
    assert run_content_reconciliation(spark, lake).count() == 3
    lake.upsert(spark, prices([("A", days[1], 2.0, at(2)), ("B", days[2], 1.0, at(2))]), "silver_prices", KEYS["silver_prices"])
    with pytest.raises(ReconciliationError, match="fact_prices_content"):
        run_content_reconciliation(spark, lake)
    diff = {json.loads(r.key)["ticker"]: (r.status, r.changed_columns) for r in read_appended(spark, lake.path("quality_content_diff")).collect()}
    assert diff == {"A": ("changed", "open,high,low,close,retrieved_at"), "B": ("missing", None)}
    # only what was retrieved since then; then a plain upsert, which leaves no images: the rollup is built anew
    assert advance_fact_prices(spark, lake, since="2024-01-02") == 1 and monthly() == [(1, 2, 3.5), (2, 2, 2.5)]
    assert run_content_reconciliation(spark, lake).where("not passed").count() == 0
    lake.upsert(spark, gold.build_fact_prices(prices([("C", days[0], 9.0, at(3))])), "fact_prices", KEYS["fact_prices"])
    assert advance_fact_prices(spark, lake, since="2024-01-05") == 2 and monthly() == [(1, 3, 12.5), (2, 2, 2.5)]


def test_statements_land_once(spark, scratch):
    from tidemark.jobs.landing import ingest_new_statements
    landing, lake = f"{scratch}/in", Lake(f"{scratch}/lake")
    put(landing, "AAA.json", json.dumps([{"date": "2023-12-31", "x": 1}, {"date": "2022-12-31", "y": {"z": 2}}]))
    put(landing, "BBB.json", json.dumps({"error": "limit"}))
    for _ in range(2):
        ingest_new_statements(spark, lake, landing, "balance_sheet", retrieved())
    table = lake.path("bronze_fmp_balance_sheet_payload_landed")
    rows = read_landed(spark, table).select("ticker", F.to_json("payload").alias("p"), "statement_type").collect()
    assert sorted(map(tuple, rows)) == [("AAA", '{"date":"2022-12-31","y":{"z":2}}', "balance_sheet"),
                                        ("AAA", '{"date":"2023-12-31","x":1}', "balance_sheet")]
    assert [(r.ticker, r.reject_reason) for r in read_landed(spark, table, rejected=True).collect()] == [("BBB", "not_json_array")]
