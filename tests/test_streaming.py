import os

from pyspark.sql import functions as F

from tidemark.plans import derive
from tidemark.sinks.upsert import read_current
from tidemark.streaming import prices as sp

from conftest import SMALL


def _stream(spark):
    schema = derive.table(spark, SMALL, "events").schema
    return sp.file_stream(spark, SMALL, schema, glob="events.parquet")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_bars_equal_batch(spark, scratch):
    bars = sp.daily_bars(sp.ticks_from_events(_stream(spark)))
    sp.start_upsert_stream(bars, os.path.join(scratch, "bars"), ["ticker", "date"],
                           os.path.join(scratch, "cp")).awaitTermination()
    got = read_current(spark, os.path.join(scratch, "bars"))
    batch = sp.daily_bars(sp.ticks_from_events(derive.table(spark, SMALL, "events")))
    assert rows(got.select(*batch.columns)) == rows(batch)


def test_stream_latest_quote_and_restart(spark, scratch):
    q = sp.latest_quotes(sp.ticks_from_events(_stream(spark)))
    path, cp = os.path.join(scratch, "q"), os.path.join(scratch, "cpq")
    sp.start_upsert_stream(q, path, ["ticker"], cp).awaitTermination()
    first = rows(read_current(spark, path))
    # a restart from the same checkpoint finds no new files: table unchanged
    sp.start_upsert_stream(sp.latest_quotes(sp.ticks_from_events(_stream(spark))), path, ["ticker"],
                           cp).awaitTermination()
    assert rows(read_current(spark, path)) == first
    batch = sp.latest_quotes(sp.ticks_from_events(derive.table(spark, SMALL, "events")))
    assert rows(batch) == first


def test_drop_alerts(spark):
    bars = spark.createDataFrame([("A", 10.0, 4.0), ("B", 10.0, 9.0)], "ticker string, open double, close double") \
        .withColumn("date", F.current_date())
    got = {r.ticker: r.alert for r in sp.drop_alerts(bars, 0.5).collect()}
    assert got == {"A": True, "B": False}


def test_stream_two_landings_and_late_rows(spark, scratch):
    """Bars are refined across micro-batches; a row older than the watermark
    is dropped by the stream (the batch rebuild picks it up)."""
    import datetime as dt
    landing = os.path.join(scratch, "landing")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    t0 = dt.datetime(2024, 1, 10, 9, 0)
    first = [(1, t0, 1, "click", 10.0, '{"k": 1}'), (2, t0 + dt.timedelta(hours=5), 1, "click", 12.0, '{"k": 2}')]
    second = [(3, t0 + dt.timedelta(hours=8), 1, "click", 6.0, '{"k": 3}'),          # same day: refines the bar
              (4, t0 + dt.timedelta(days=3), 1, "click", 7.0, '{"k": 4}')]           # moves the watermark
    late = [(5, t0 - dt.timedelta(days=5), 1, "click", 99.0, '{"k": 5}')]            # behind the watermark
    table, cp = os.path.join(scratch, "bars"), os.path.join(scratch, "cp")
    ev_schema = spark.createDataFrame([], schema).schema

    def run():
        ticks = sp.ticks_from_events(sp.file_stream(spark, landing, ev_schema))
        sp.start_upsert_stream(sp.daily_bars(ticks), table, ["ticker", "date"], cp, state_partitions=2
                               ).awaitTermination()

    for i, batch in enumerate((first, second, late)):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(landing)
        run()
    bars = {str(r.date): (r.open, r.close, r.n_ticks) for r in read_current(spark, table).collect()}
    assert bars["2024-01-10"] == (10.0, 6.0, 3)
    assert "2024-01-05" not in bars
