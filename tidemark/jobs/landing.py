"""Landing folders read as streams: every run takes the files that no earlier run has taken.

A landing folder is the source of an ``availableNow`` stream, whose checkpoint is the record
of ingested files. Each micro-batch writes one folder ``landing_batch=<id>`` of the table, as
a whole, so a batch that ran again after a crash between its write and its checkpoint
replaces what it wrote before, and every landed row is in the table once. The checkpoint
lies inside the table's folder, so the two cannot be parted by accident.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.columns import provenance
from tidemark.jobs.bronze import _object_reason, _rule_reason
from tidemark.jobs.lake import BRONZE_PARTITION, STATEMENT_TYPES, Lake
from tidemark.operators.quality import fx_rules, price_rules
from tidemark.schemas import BRONZE_PRICES, PRICE_CSV
from tidemark.session import fresh_dir
from tidemark.sources import landed

#: the table's column that tells which micro-batch wrote a row
BATCH = "landing_batch"
#: hidden from readers, as its name starts with an underscore
_CHECKPOINT = "_landing_checkpoint"


def file_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """(file_path, body): landed files as a stream, one row per file.

    For API responses (one symbol's or one request's file, bounded by the API); a file
    counts once, by its path, so a corrected delivery needs a new name.
    """
    # the reader would skip files that were written long before the newest one it has seen
    reader = spark.readStream.schema("value string").option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(landing, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body"))


def ingest_new_files(spark: SparkSession, landing: str, table: str, parse: Callable[[DataFrame], DataFrame],
                     max_files: int | None = None) -> int:
    """Land what is new in ``landing`` into ``table``; returns the number of micro-batches.

    ``parse`` maps (file_path, body) rows to table rows with a ``reject_reason``; those
    with a reason go to ``<table>_quarantine``. Rows are parsed once, into the shared work
    folder, so what is accepted and rejected adds up to what was landed. A run without new
    files writes nothing. One writer per table.
    """
    done = []

    def write(batch: DataFrame, batch_id: int) -> None:
        staged_at = fresh_dir(spark, "landing-stage")
        rows = parse(batch)
        rows.write.parquet(staged_at)
        staged = spark.read.schema(rows.schema).parquet(staged_at)
        accepted = F.col("reject_reason").isNull()
        for out, path in ((staged.where(accepted).drop("reject_reason", "raw", "landed_file"), table),
                          (staged.where(~accepted), f"{table}_quarantine")):
            w = out.write.mode("overwrite")  # the batch's own folder only
            if BRONZE_PARTITION in out.columns:
                w = w.partitionBy(BRONZE_PARTITION)
            w.parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")
        done.append(batch_id)

    query = (file_stream(spark, landing, max_files).writeStream.foreachBatch(write).trigger(availableNow=True)
             .option("checkpointLocation", f"{table.rstrip('/')}/{_CHECKPOINT}").start())
    query.awaitTermination()
    return len(done)


def ingest_new_statements(spark: SparkSession, lake: Lake, landing: str, statement_type: str, retrieved_at,
                          source: str = "fmp", max_files: int | None = None) -> int:
    """The files that are new in ``landing`` -> ``<statement table>_payload_landed``, each record once over all runs."""
    return ingest_new_files(spark, landing, lake.path(f"{STATEMENT_TYPES[statement_type]}_payload_landed"),
                            statement_files(statement_type, source, retrieved_at), max_files)


def read_landed(spark: SparkSession, table: str, rejected: bool = False) -> DataFrame:
    """The table (or its quarantine) with its ``landing_batch``; columns of all batches are merged."""
    return spark.read.option("mergeSchema", True).parquet(f"{table.rstrip('/')}_quarantine" if rejected else table)


def price_files(tickers: DataFrame, source: str, retrieved_at, rules: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """The parser of daily OHLCV files ``<symbol>.csv`` (:func:`ingest_new_files`).

    A file with an unexpected first line is rejected as a whole, one entry per line after
    it (or one for a file without any); so are lines of unknown symbols, lines that do not
    parse or have no date, and lines for which ``rules`` names a broken rule.
    """
    symbols = tickers.select(F.col("stooq_symbol").alias("__symbol"), "ticker")

    def parse(files: DataFrame) -> DataFrame:
        # \r\n and \n both end a line; what follows the last end is no line
        lines = F.split(F.regexp_replace("body", r"\r?\n\z", ""), "\r?\n")
        heads = landed.csv_header_status(files.select("file_path", F.get(lines, F.lit(0)).alias("first_line"),
                                                      F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("rest")))
        # a wrong file without lines still leaves one entry
        one = F.when((F.size("rest") == 0) & ~F.col("header_ok"), F.array(F.lit(None).cast("string"))).otherwise(F.col("rest"))
        each = heads.select(landed.file_stem(F.col("file_path")).alias("__symbol"), F.col("file_path").alias("landed_file"),
                            "first_line", "header_ok", F.explode(one).alias("line"))
        each = each.where(F.col("line").isNull() | (F.trim("line") != ""))
        schema = StructType(PRICE_CSV.fields + [StructField("_corrupt_record", StringType(), True)])
        fields = F.from_csv("line", schema.simpleString(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        parsed = each.withColumn("r", fields).select(
            "__symbol", "landed_file", "first_line", "header_ok", "line", F.col("r._corrupt_record").alias("_corrupt_record"),
            *[F.col(f"r.{f.name}").alias(f.name.lower()) for f in PRICE_CSV.fields]).join(symbols, "__symbol", "left")
        bad = F.col("_corrupt_record")
        reason = (F.when(~F.col("header_ok"), "header").when(bad.isNotNull(), "row does not parse")
                  .when(F.col("date").isNull() | (F.trim("date") == ""), "row does not parse")
                  .when(F.col("ticker").isNull(), "unknown symbol"))
        if rules is not None:
            reason = F.coalesce(reason, rules)
        rows = provenance(parsed, source, retrieved_at).withColumn(BRONZE_PARTITION, F.to_date("retrieved_at"))
        return rows.select(*[f.name for f in BRONZE_PRICES.fields], BRONZE_PARTITION, "landed_file",
                           F.coalesce("line", "first_line").alias("raw"), reason.alias("reject_reason"))
    return parse


def rate_files(source: str, retrieved_at, rules: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """The parser of FX rate payloads, one JSON object per file; other bodies are rejected as a whole."""
    def parse(files: DataFrame) -> DataFrame:
        judged = files.withColumn("reject_reason", _object_reason(F.col("body"), "rates"))
        good = landed.fx_rows_from_json(judged.where(F.col("reject_reason").isNull()), "body", source, retrieved_at)
        reason = rules if rules is not None else F.lit(None).cast("string")
        good = good.withColumn("reject_reason", reason).withColumn(BRONZE_PARTITION, F.to_date("retrieved_at"))
        bad = judged.where(F.col("reject_reason").isNotNull())
        return good.unionByName(bad.select(F.col("body").alias("raw"), F.col("file_path").alias("landed_file"), "reject_reason"),
                                allowMissingColumns=True)
    return parse


def statement_files(statement_type: str, source: str, retrieved_at) -> Callable[[DataFrame], DataFrame]:
    """The parser of statement payloads ``<ticker>.json``, a JSON array each; every record is kept as a VARIANT ``payload``."""
    def parse(files: DataFrame) -> DataFrame:
        status = landed.classify_payload(F.col("body"), "json_array")
        judged = files.select(landed.file_stem(F.col("file_path")).alias("ticker"), "file_path", "body",
                              F.when(status != "ok", status).alias("reject_reason"))
        good = landed.statement_records(judged.where(F.col("reject_reason").isNull()), "body", keep=["ticker"])
        good = provenance(good.withColumn("statement_type", F.lit(statement_type)), source, retrieved_at)
        good = good.withColumn(BRONZE_PARTITION, F.to_date("retrieved_at")).withColumn("reject_reason", F.lit(None).cast("string"))
        bad = judged.where(F.col("reject_reason").isNotNull())
        return good.unionByName(bad.select("ticker", F.col("body").alias("raw"), F.col("file_path").alias("landed_file"), "reject_reason"),
                                allowMissingColumns=True)
    return parse


def ingest_new_prices(spark: SparkSession, lake: Lake, landing: str, tickers: DataFrame, retrieved_at,
                      source: str = "stooq", validate: bool = True, max_files: int | None = None) -> int:
    """The files that are new in ``landing`` -> ``bronze_stooq_prices_landed``, each row once over all runs."""
    parse = price_files(tickers, source, retrieved_at, _rule_reason(price_rules()) if validate else None)
    return ingest_new_files(spark, landing, lake.path("bronze_stooq_prices_landed"), parse, max_files)


def ingest_new_fx(spark: SparkSession, lake: Lake, landing: str, retrieved_at, source: str = "nbp",
                  validate: bool = True, max_files: int | None = None) -> int:
    """The files that are new in ``landing`` -> ``bronze_nbp_fx_rates_landed``, each row once over all runs."""
    parse = rate_files(source, retrieved_at, _rule_reason(fx_rules()) if validate else None)
    return ingest_new_files(spark, landing, lake.path("bronze_nbp_fx_rates_landed"), parse, max_files)
