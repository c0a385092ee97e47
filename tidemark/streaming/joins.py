"""Stateful stream steps: redelivered events once, and ticks converted by a stream of rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.prices import start_append_stream


def first_deliveries(events: DataFrame, keys: Sequence[str], event_time: str = "ts", watermark: str = "1 day") -> DataFrame:
    """Each event once, however often it is delivered within the watermark delay.

    The state holds the keys of the last ``watermark`` only. A redelivery that is later than
    that is behind the watermark and dropped as late, unless its event time is newer than
    the first one's; an event delivered for the first time behind the watermark is dropped
    too, and the next batch rebuild picks it up. A null key is a key like any other.
    """
    return events.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))


def convert_ticks(ticks: DataFrame, rates: DataFrame, validity: str = "1 day", tick_delay: str = "1 hour",
                  rate_delay: str = "1 day", how: str = "inner") -> DataFrame:
    """Ticks (currency, ts, price, any others) with the rate that holds at their time, both sides streams or batches.

    ``rates`` has (currency, valid_from, rate); a rate holds from ``valid_from`` for
    ``validity``, so rates of one currency must not come closer together than that, or a
    tick meets several. Rows later than their side's delay are dropped. Both states are
    bounded: a rate is kept until no tick in its validity can come any more, a tick until
    no rate that holds at its time can. ``how='left'`` also gives ticks without a rate, once
    the watermark has passed them.
    """
    r = rates.select(F.col("currency").alias("__currency"), "valid_from", "rate")
    if ticks.isStreaming:
        ticks = ticks.withWatermark("ts", tick_delay)
        r = r.withWatermark("valid_from", rate_delay)
    holds = ((F.col("currency") == F.col("__currency")) & (F.col("ts") >= F.col("valid_from"))
             & (F.col("ts") < F.col("valid_from") + F.expr(f"INTERVAL {validity}")))
    return (ticks.join(r, holds, "left_outer" if how == "left" else "inner").drop("__currency")
            .withColumn("converted", F.col("price") * F.col("rate")))


def start_stateful_append(df: DataFrame, table_path: str, checkpoint: str, state_partitions: int,
                          available_now: bool = True) -> StreamingQuery:
    """:func:`start_append_stream` with the state store sized to the state, not to the input.

    Streaming takes the number from ``spark.sql.shuffle.partitions`` at the query's first
    start and keeps it in the checkpoint.
    """
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return start_append_stream(df, table_path, checkpoint, available_now)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
