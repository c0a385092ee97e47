"""Registered queries of incremental landing, content checks, maintained rollups, as-of and band joins, stateful streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dedup, standardize
from tidemark.plans import derive as d
from tidemark.schemas import BRONZE_PRICES
from tidemark.session import fresh_dir

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def incremental_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Price files that land in two instalments, ingested by three runs of one job:
    each row once, with the micro-batch that took it; the last run finds nothing new."""
    from tidemark.jobs.lake import Lake
    from tidemark.jobs.landing import ingest_new_prices, read_landed
    from tidemark.sinks.upsert import _fs
    base = fresh_dir(spark, "landing", "instalments")
    landing, lake = d.land_price_csv(spark, sf, base), Lake(f"{base}/lake")
    fs, inbox = _fs(spark, f"{base}/inbox")
    fs.mkdirs(inbox)
    files = [f.getPath() for f in fs.listStatus(_fs(spark, landing)[1])]
    for rest in (0, 1, None):
        for f in files:
            if rest is not None and int(f.getName()[1:].split(".")[0]) % 2 == rest:
                fs.rename(f, _fs(spark, f"{base}/inbox/{f.getName()}")[1])
        ingest_new_prices(spark, lake, f"{base}/inbox", d.symbol_map(spark, sf), F.to_timestamp_ntz(F.lit(d.RUN1_AT)))
    return read_landed(spark, lake.path("bronze_stooq_prices_landed")).select(
        *[f.name for f in BRONZE_PRICES.fields], "landing_batch")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def changed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The orders after rows were lost, changed, added and repeated."""
    o, k = _orders(spark, sf), F.col("o_orderkey")
    kept = o.where(k % 101 != 0).select(
        "o_orderkey", F.when(k % 89 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 83 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 97 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"), "o_orderdate")
    extra = o.where(k % 103 == 0).withColumn("o_orderkey", -k)
    again = kept.where(k % 107 == 0)
    return kept.unionByName(extra).unionByName(again)


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query
def content_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The orders whose rows differ between two layers with nearly equal counts and ranges."""
    from tidemark.operators.reconcile import content_diff as diff
    return diff(_orders(spark, sf), changed_orders(spark, sf), ["o_orderkey"], _ORDER_COLUMNS)


@query
def content_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Content checks beside counts and ranges: equal layers in another order, and layers
    whose prices moved, though their counts and keys agree."""
    from tidemark.operators.quality import compare_range, compare_row_counts
    from tidemark.operators.reconcile import compare_content
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    swapped = o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(k % 50 == 0, 1.0).when(k % 50 == 25, -1.0).otherwise(0.0))
    out = compare_content(o, o.repartition("o_custkey"), ["o_orderkey"], _ORDER_COLUMNS, "same rows")
    out = out.unionByName(compare_content(o, swapped, ["o_orderkey"], _ORDER_COLUMNS, "prices moved"))
    out = out.unionByName(compare_row_counts(o, swapped, True, "prices moved: counts"))
    out = out.unionByName(compare_range(o, swapped, "o_orderkey", "o_orderkey", "prices moved: key range"))
    # which leaves a key falls into is the hash's business
    return out.select("check_name", "check_kind", "passed", "source_count", "target_count", "target_empty")


def price_increments(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The facts as a first load and three increments: inserts, corrected closes, a moved label."""
    p = standardize.standardize_prices(dedup.dedup_prices(d.bronze_prices(spark, sf))).select("ticker", "date", "source", "close")
    p = p.withColumn("close", F.col("close").cast("decimal(18,2)"))
    day = F.dayofmonth("date")
    return [p.where(day % 3 != 0),
            p.where((day % 3 == 0) | (day % 5 == 0)).withColumn("close", F.when(day % 5 == 0, F.col("close") + 1).otherwise(
                F.col("close")).cast("decimal(18,2)")),
            p.where(day % 7 == 0).withColumn("close", (F.col("close") + 2).cast("decimal(18,2)")),
            p.where(day % 11 == 0).withColumn("source", F.lit("moved"))]


@query
def rollup_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly rollup of the price facts after a load and three increments, kept up
    to date by retracting and adding the rows that each merge changed."""
    from tidemark.jobs.rollups import merge_facts, read_rollup, refresh_rollup
    base = fresh_dir(spark, "tables", "maintained")
    groups = {"source": F.col("source"), "year": F.year("date"), "month": F.month("date")}
    sums = {"sum_close": F.col("close")}
    for increment in price_increments(spark, sf):
        merge_facts(spark, increment, f"{base}/facts", ["ticker", "date"])
        refresh_rollup(spark, f"{base}/facts", f"{base}/monthly", groups, sums)
    return read_rollup(spark, f"{base}/monthly").select("source", "year", "month", "n_rows", F.col("sum_close").cast("decimal(38,2)"))


def quotes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(trades, quotes) of the events; one key holds a third of all rows."""
    ev = d.table(spark, sf, "events")
    book = F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("T"), (F.col("user_id") % 20).cast("string")))
    ev = ev.select(book.alias("book"), "event_id", "event_type", "ts", "value")
    return (ev.where(F.col("event_type") != "view").select("book", "event_id", "ts", F.col("value").alias("price")),
            ev.where(F.col("event_type") == "view").select("book", F.col("ts").alias("quoted_at"), F.col("value").alias("bid")))


@query
def asof_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Every trade with the last quote of its book, by timestamp."""
    from tidemark.operators.asof import asof_join_sorted
    trades, bids = quotes(spark, sf)
    return asof_join_sorted(trades, bids, ["book"], "ts", "quoted_at", ["bid"])


@query
def asof_quotes_tolerance(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with quotes that are at most half an hour old."""
    from tidemark.operators.asof import asof_join_sorted
    trades, bids = quotes(spark, sf)
    return asof_join_sorted(trades, bids, ["book"], "ts", "quoted_at", ["bid"], tolerance="30 minutes")


@query
def cross_source_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Two vendors' closes whose dates differ by up to two days, matched to the nearest day."""
    from tidemark.operators.band import nearest_match
    p = standardize.standardize_prices(dedup.dedup_prices(d.bronze_prices(spark, sf))).select("ticker", "date", "close", "source")
    a = p.where(F.col("source") != "error").select("ticker", "date", "close")
    shift = F.dayofmonth("date") % 4
    b = (p.where(F.col("source") != "view").withColumn("date", F.date_add("date", shift.cast("int")))
         .groupBy("ticker", "date").agg(F.max("close").alias("close")))
    return nearest_match(a, b, ["ticker"], "date", "close", 2, 0.5)


@query
def peer_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quartiles of line prices in peer groups by part size, one of which holds a third of all lines."""
    from tidemark.operators.ranking import grouped_quantiles
    li = d.table(spark, sf, "lineitem")
    group = F.when(F.col("l_partkey") % 3 == 0, "large").otherwise(F.concat(F.lit("P"), (F.col("l_partkey") % 40).cast("string")))
    return grouped_quantiles(li.select(group.alias("peer_group"), "l_extendedprice"), ["peer_group"], "l_extendedprice",
                             [0.0, 0.25, 0.5, 0.75, 1.0])


def _parallel(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


@query
def stream_first_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Events delivered twice, in two of three files, appended once each over three micro-batches."""
    from tidemark.streaming.joins import first_deliveries, start_stateful_append
    from tidemark.streaming.prices import file_stream
    base = fresh_dir(spark, "streams", "redelivered")
    ev = d.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for k in range(3):
        ev.where(F.col("event_id") % 3 != k).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    stream = file_stream(spark, f"{base}/landing", ev.schema, max_files_per_trigger=1)
    start_stateful_append(first_deliveries(stream, ["event_id"], watermark="3650 days"), f"{base}/table", f"{base}/checkpoint",
                          _parallel(spark)).awaitTermination()
    return spark.read.parquet(f"{base}/table").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_converted_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks converted by a second stream with one rate a day and currency, over several micro-batches."""
    from tidemark.streaming.joins import convert_ticks, start_stateful_append
    from tidemark.streaming.prices import file_stream
    base = fresh_dir(spark, "streams", "converted")
    ev = d.table(spark, sf, "events").select("event_id", F.upper("event_type").alias("currency"), F.col("ts").cast("timestamp").alias("ts"),
                                             F.col("value").alias("price"))
    day = F.date_trunc("day", "ts")
    rates = (ev.where(F.dayofmonth("ts") % 4 != 0).groupBy("currency", day.alias("valid_from")).agg(F.max("price").alias("rate")))
    # a file holds a stretch of time, so nothing comes later than the delays allow
    ev.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{base}/ticks")
    rates.repartitionByRange(4, "valid_from").sortWithinPartitions("valid_from").write.parquet(f"{base}/rates")
    sides = [file_stream(spark, f"{base}/{name}", df.schema, max_files_per_trigger=1) for name, df in (("ticks", ev), ("rates", rates))]
    out = convert_ticks(*sides, tick_delay="400 days", rate_delay="400 days")
    start_stateful_append(out, f"{base}/table", f"{base}/checkpoint", _parallel(spark)).awaitTermination()
    return spark.read.parquet(f"{base}/table").select("event_id", "currency", F.col("ts").cast("timestamp_ntz").alias("ts"), "price",
                                                      "rate", "converted")


@query
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two merges into a table bucketed by its key; only the increments are exchanged."""
    import uuid

    from tidemark.sinks.bucketed import merge_bucketed
    name = f"tidemark_orders_{uuid.uuid4().hex[:8]}"
    o = d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    merge_bucketed(spark, o.where(F.col("o_orderstatus") != "P"), name, ["o_orderkey"])
    for kept in ("P", "F"):
        more = o.where(F.col("o_orderstatus") == kept).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
        merge_bucketed(spark, more, name, ["o_orderkey"])
    return spark.table(name)


def nested_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """(batch, payload): events as nested JSON whose shape changed with the second batch."""
    ev = d.table(spark, sf, "events")
    early = F.dayofmonth("ts") <= 15
    old = F.struct(F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("id"), F.struct(F.col("value").alias("score")).alias("rank"))
                   .alias("user"), F.array(F.struct(F.col("event_type").alias("name"), F.lit(1).alias("weight"))).alias("tags"))
    new = F.struct(F.col("event_id").cast("string").alias("id"),
                   F.struct(F.col("user_id").alias("id"), F.struct(F.col("value").cast("string").alias("score"), F.lit(True).alias("live"))
                            .alias("rank")).alias("user"),
                   F.array(F.struct(F.col("event_type").alias("name"), F.array(F.lit(1.5)).alias("marks"))).alias("tags"))
    return ev.select(F.when(early, "old").otherwise("new").alias("batch"),
                     F.when(early, F.to_json(old)).otherwise(F.to_json(new)).alias("payload"))


@query
def nested_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Fields added, removed and retyped at any depth and inside arrays, from one type aggregate per batch."""
    from tidemark.operators.nested import nested_drift as drift
    return drift(nested_payloads(spark, sf), "batch", "payload", "old", "new")
