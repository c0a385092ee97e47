"""Streaming prices.

Event time is the trade time; the watermark is one day and windows are
one-day tumbling windows. Aggregates run in *update* mode and every
micro-batch is merged into its table with the keyed upsert, so a window that
is still open is refined by later batches and the table always equals the
batch computation over the same rows (append mode would hold back windows
still inside the watermark). Rows later than the watermark are dropped by
the stream; the next batch rebuild picks them up.

``foreachBatch`` is at-least-once; the upsert is idempotent, so a replayed
batch leaves the table unchanged. Checkpoints live under the shared
``spark.checkpoint.dir``, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sinks.upsert import upsert, upsert_partitions, vacuum

WATERMARK = "1 day"
BAR_WINDOW = "1 day"


def file_stream(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source over a landing folder (new files are picked up as they land)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def kafka_ticks(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest") -> DataFrame:
    """Trades from a Kafka topic (JSON values ``{ticker, ts, price, qty}``).

    Needs the Kafka connector on the classpath; raises a clear error without it.
    """
    try:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
               .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    except Exception as e:  # noqa: BLE001 - surface the missing connector plainly
        raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath") from e
    t = F.from_json(F.col("value").cast("string"), "ticker string, ts timestamp, price double, qty bigint")
    return raw.select(t.alias("t")).select("t.*")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """(ticker, ts, price, qty) from event rows; ``ts`` as a UTC timestamp
    (watermarks need ``TIMESTAMP``, not ``TIMESTAMP_NTZ``)."""
    return events.select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("qty"))


def daily_bars(ticks: DataFrame, watermark: str = WATERMARK, window: str = BAR_WINDOW) -> DataFrame:
    """OHLCV per (ticker, day): open/close are the first/last price by event time; equal
    times are ordered by price and quantity."""
    at = F.struct("ts", "price", "qty")
    t = ticks.withWatermark("ts", watermark) if ticks.isStreaming else ticks
    g = t.groupBy(F.window("ts", window).alias("w"), "ticker").agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", at).alias("close"), F.sum("qty").alias("volume"),
        F.count(F.lit(1)).alias("n_ticks"))
    return g.select("ticker", F.to_date(F.col("w.start")).alias("date"), "open", "high", "low", "close",
                    "volume", "n_ticks")


def latest_quotes(ticks: DataFrame) -> DataFrame:
    """Current quote per ticker: the price at the latest event time (of equal times, the
    highest price)."""
    q = ticks.groupBy("ticker").agg(F.max(F.struct("ts", "price", "qty")).alias("q"))
    return q.select("ticker", F.col("q.price").alias("price"), F.col("q.ts").alias("quote_ts"))


def drop_alerts(bars: DataFrame, threshold: float) -> DataFrame:
    """Bars with ``drop_pct`` = (open - close) / open and an ``alert`` flag
    when the fall within the day reaches ``threshold`` (0.1 = 10 %); a zero
    open gives a null ``drop_pct`` and no alert."""
    pct = F.try_divide(F.col("open") - F.col("close"), F.col("open"))  # null when open is 0
    return bars.select("ticker", "date", "open", "close", pct.alias("drop_pct"),
                       F.coalesce(pct >= F.lit(threshold), F.lit(False)).alias("alert"))


def upsert_sink(table_path: str, keys: Sequence[str],
                transform: Callable[[DataFrame], DataFrame] | None = None,
                writer: Callable[..., int] | None = None, partition_by: Sequence[str] = ()):
    """A ``foreachBatch`` function merging each micro-batch into a table.

    ``partition_by`` (part of the keys) rewrites only the partitions a batch touches;
    without it each batch writes a snapshot and the two newest are kept, which suits
    small tables. ``writer`` replaces both (e.g. a Lake's upsert)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        out = transform(batch) if transform else batch
        if not out.isEmpty():
            if writer is None and partition_by:
                upsert_partitions(batch.sparkSession, out, table_path, keys, partition_by)
            elif writer is None:
                upsert(batch.sparkSession, out, table_path, keys)
                vacuum(batch.sparkSession, table_path, keep=2)
            else:
                writer(out)
    return run


def start_upsert_stream(df: DataFrame, table_path: str, keys: Sequence[str], checkpoint: str,
                        transform: Callable[[DataFrame], DataFrame] | None = None,
                        available_now: bool = True, name: str | None = None,
                        state_partitions: int | None = None,
                        writer: Callable[[DataFrame], int] | None = None,
                        partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Run an aggregate stream in update mode into an upserted table.

    ``state_partitions`` sizes the state store (and its shuffle). Streaming
    takes it from ``spark.sql.shuffle.partitions`` at the query's first start
    and keeps it in the checkpoint; AQE does not resize it. Size it to the
    state (tickers x open windows), not to the input.
    """
    w = (df.writeStream.outputMode("update").foreachBatch(upsert_sink(table_path, keys, transform, writer, partition_by))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    if state_partitions is None:
        return w.start()
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def start_append_stream(df: DataFrame, table_path: str, checkpoint: str, available_now: bool = True,
                        partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append raw rows to a Bronze Parquet table (exactly-once file sink)."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_path)
