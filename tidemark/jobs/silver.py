"""Silver jobs: keep latest, type, label, reshape, then upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.jobs.lake import STATEMENT_TYPES, Lake
from tidemark.operators import dedup, reshape, standardize
from tidemark.operators.joins import add_currency_column
from tidemark.schemas import KEYS


# Source precedence in Silver prices: a streamed bar beats a batch row of the
# same (ticker, date), and a bar rebuilt from all stored ticks beats both, as the
# stream drops ticks that come after its watermark; within one source the later
# retrieval wins.
BATCH_PRIORITY = 1
STREAM_PRIORITY = 2
REBUILD_PRIORITY = 3
PRICE_PRECEDENCE = ["source_priority", "retrieved_at"]


def silver_prices_frame(bronze: DataFrame, tickers: DataFrame, priority: int = BATCH_PRIORITY) -> DataFrame:
    """Bronze prices -> Silver rows: keep latest, parse dates, label currency, stamp priority."""
    df = add_currency_column(standardize.standardize_prices(dedup.dedup_prices(bronze)), tickers)
    return df.withColumn("source_priority", F.lit(priority))


def build_silver_prices(spark: SparkSession, lake: Lake, tickers: DataFrame, since=None) -> int:
    """``since`` restricts the run to retrievals on/after that day (partition
    pruning). The merge is conditional on (``source_priority``,
    ``retrieved_at``): an increment never rolls back a row stored from a
    later retrieval or from the stream."""
    df = silver_prices_frame(lake.read_bronze(spark, "bronze_stooq_prices", since), tickers)
    return lake.upsert(spark, df, "silver_prices", KEYS["silver_prices"], newer_wins=PRICE_PRECEDENCE)


def start_silver_prices_stream(spark: SparkSession, lake: Lake, ticks: DataFrame, tickers: DataFrame,
                               checkpoint: str, available_now: bool = False, state_partitions: int | None = None):
    """Daily bars from a tick stream merged into the same ``silver_prices``
    table as the batch job, with stream precedence (B12 + B15).

    Each micro-batch's updated bars become Silver price rows (``source`` =
    ``stream``, ``retrieved_at`` = the micro-batch time) and go through the
    conditional upsert, so a later batch rebuild cannot overwrite them.
    """
    from tidemark.streaming.prices import daily_bars, start_upsert_stream
    bars = daily_bars(ticks)

    def to_silver(b: DataFrame) -> DataFrame:
        rows = b.select("ticker", "date", "open", "high", "low", "close", "volume",
                        F.lit("stream").alias("source"), F.current_timestamp().alias("retrieved_at"))
        t = tickers.select("ticker", "currency")
        return add_currency_column(rows, t).withColumn("source_priority", F.lit(STREAM_PRIORITY))

    def write(df: DataFrame) -> int:
        return lake.upsert(df.sparkSession, df, "silver_prices", KEYS["silver_prices"],
                           newer_wins=PRICE_PRECEDENCE)

    return start_upsert_stream(bars, lake.path("silver_prices"), KEYS["silver_prices"], checkpoint,
                               transform=to_silver, available_now=available_now,
                               state_partitions=state_partitions, writer=write)


def rebuild_bars(spark: SparkSession, lake: Lake, ticks: DataFrame, tickers: DataFrame) -> int:
    """Closed days' bars computed again from all stored ``ticks`` (ticker, ts, price, qty),
    late ones included; they replace the stream's bars of those days."""
    from tidemark.streaming.prices import daily_bars
    rows = daily_bars(ticks).select("ticker", "date", "open", "high", "low", "close", "volume",
                                    F.lit("rebuild").alias("source"), F.current_timestamp().alias("retrieved_at"))
    df = add_currency_column(rows, tickers.select("ticker", "currency")).withColumn("source_priority",
                                                                                    F.lit(REBUILD_PRIORITY))
    return lake.upsert(spark, df, "silver_prices", KEYS["silver_prices"], newer_wins=PRICE_PRECEDENCE)


def build_silver_fx_rates(spark: SparkSession, lake: Lake, since=None) -> int:
    """Upsert ``silver_fx_rates`` (keep latest, parse dates; newer wins)."""
    df = standardize.standardize_fx_rates(dedup.dedup_fx_rates(lake.read_bronze(spark, "bronze_nbp_fx_rates", since)))
    return lake.upsert(spark, df, "silver_fx_rates", KEYS["silver_fx_rates"], newer_wins="retrieved_at")


def bronze_statements(spark: SparkSession, lake: Lake, since=None) -> DataFrame:
    """The three statement tables, stamped with their type and unioned by name."""
    from tidemark.operators.union import union_all_by_name
    frames = [lake.read_bronze(spark, t, since).withColumn("statement_type", F.lit(st))
              for st, t in STATEMENT_TYPES.items() if lake_has(spark, lake, t)]
    return union_all_by_name(frames)


def lake_has(spark: SparkSession, lake: Lake, table: str) -> bool:
    """True when the table folder exists."""
    from tidemark.sinks.upsert import _fs
    fs, p = _fs(spark, lake.path(table))
    return fs.exists(p)


def build_silver_fundamentals(spark: SparkSession, lake: Lake, since=None) -> int:
    """Upsert ``silver_fundamentals`` from the wide statement tables (unpivoted)."""
    std = standardize.standardize_fundamentals(dedup.dedup_fundamentals(bronze_statements(spark, lake, since)))
    return lake.upsert(spark, reshape.unpivot_statement_metrics(std), "silver_fundamentals",
                       KEYS["silver_fundamentals"], newer_wins="retrieved_at")


def build_silver_macro(spark: SparkSession, lake: Lake, since=None) -> int:
    """Upsert ``silver_macro`` (keep latest, country and reference date)."""
    df = standardize.standardize_macro(dedup.dedup_macro(lake.read_bronze(spark, "bronze_gus_macro", since)))
    return lake.upsert(spark, df, "silver_macro", KEYS["silver_macro"], newer_wins="retrieved_at")


def build_silver_fundamentals_from_payloads(spark: SparkSession, lake: Lake, since=None) -> int:
    """Silver fundamentals from the payload Bronze tables (VARIANT path)."""
    frames = [lake.read_bronze(spark, t + "_payload", since) for t in STATEMENT_TYPES.values()
              if lake_has(spark, lake, t + "_payload")]
    bronze = frames[0]
    for f in frames[1:]:
        bronze = bronze.unionByName(f)
    typed = reshape.statement_envelope(bronze)
    # ties on retrieved_at: the later record position in the landed array wins
    latest = dedup.keep_latest(typed, ["ticker", "date", "period", "statement_type"], tie_break=["record_pos"])
    std = standardize.standardize_fundamentals(latest.drop("record_pos"))
    return lake.upsert(spark, reshape.statements_from_payload(std), "silver_fundamentals",
                       KEYS["silver_fundamentals"], newer_wins="retrieved_at")
