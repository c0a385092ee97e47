"""Landed payloads -> typed Bronze rows, parsed on executors.

Raw API bodies are landed as files (or as a text column) and parsed with
``spark.read`` / ``from_csv`` / ``from_json`` / VARIANT, so the driver never
touches records and one multi-file scan replaces per-request loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from tidemark.functions.columns import provenance
from tidemark.operators.joins import checked_broadcast
from tidemark.schemas import BRONZE_PRICES, EXPECTED_PRICE_CSV_HEADER, FX_PAYLOAD, MACRO_PAYLOAD, PRICE_CSV


class PayloadError(RuntimeError):
    """A landed body is not what the source contract promises."""


class EmptyBatchError(RuntimeError):
    """A whole ingestion batch produced no rows."""


# ---- A01/A02: daily OHLCV CSV ------------------------------------------------------

def price_rows_from_csv_lines(df: DataFrame, line_col: str, ticker: Column | str, source: str,
                              retrieved_at) -> DataFrame:
    """CSV data lines in a text column -> Bronze price rows (``from_csv``).

    Blank lines are skipped; a line with too few fields keeps nulls and is
    flagged in ``_corrupt_record`` by the permissive parser (quarantine with
    :func:`split_corrupt`).
    """
    schema = StructType(PRICE_CSV.fields + [StructField("_corrupt_record", StringType(), True)])
    lines = df.where(F.trim(F.col(line_col)) != "")
    parsed = lines.select(
        (F.col(ticker) if isinstance(ticker, str) else ticker).alias("ticker"),
        F.from_csv(F.col(line_col), schema.simpleString(),
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    rows = parsed.select(
        "ticker", F.col("r.Date").alias("date"), F.col("r.Open").alias("open"), F.col("r.High").alias("high"),
        F.col("r.Low").alias("low"), F.col("r.Close").alias("close"), F.col("r.Volume").alias("volume"),
        F.col("r._corrupt_record").alias("_corrupt_record"))
    return provenance(rows, source, retrieved_at)


def read_price_csv(spark: SparkSession, path: str | Sequence[str], symbol_map: DataFrame | None,
                   source: str, retrieved_at, strict_header: bool = False) -> DataFrame:
    """Landed CSV files (one per symbol, with header) -> Bronze prices.

    The ticker comes from the file name (``<symbol>.csv``) mapped through
    ``symbol_map`` (stooq_symbol -> ticker); without a map the file stem is
    the ticker. Header lines are skipped by the reader; check them per file
    with :func:`csv_header_status` (quarantine), or pass ``strict_header``
    to have the reader fail the job on the first file whose header does not
    match the schema (``enforceSchema=false``).
    """
    schema = StructType(PRICE_CSV.fields + [StructField("_corrupt_record", StringType(), True)])
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("enforceSchema", not strict_header).csv(path))
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1)
    df = raw.select(stem.alias("__symbol"), F.col("_metadata.file_path").alias("landed_file"), "*")
    if symbol_map is not None:
        m = symbol_map.select(F.col("stooq_symbol").alias("__symbol"), "ticker")
        df = df.join(checked_broadcast(m), on="__symbol", how="left")
    else:
        df = df.withColumn("ticker", F.col("__symbol"))
    # a row without a date is as unusable as one that does not parse
    whole = F.concat_ws(",", "Date", "Open", "High", "Low", "Close", "Volume")
    df = df.withColumn("_corrupt_record", F.coalesce("_corrupt_record", F.when(
        F.col("Date").isNull() | (F.trim("Date") == ""), F.concat(F.lit("no date: "), whole))))
    rows = df.select(
        "ticker", F.col("Date").alias("date"), F.col("Open").alias("open"), F.col("High").alias("high"),
        F.col("Low").alias("low"), F.col("Close").alias("close"), F.col("Volume").alias("volume"),
        "_corrupt_record", "landed_file")
    return provenance(rows, source, retrieved_at)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without ``_corrupt_record``, quarantined rows)."""
    bad = F.col("_corrupt_record").isNotNull()
    return df.where(~bad).drop("_corrupt_record"), df.where(bad)


def to_bronze_prices(df: DataFrame) -> DataFrame:
    """Project to the Bronze prices contract (drops parser helper columns,
    e.g. ``_corrupt_record`` and ``landed_file``)."""
    return df.select(*[f.name for f in BRONZE_PRICES.fields])


def csv_header_status(first_lines: DataFrame, line_col: str = "first_line",
                      expected: Sequence[str] = EXPECTED_PRICE_CSV_HEADER) -> DataFrame:
    """Flag landed files whose first line is not the expected header."""
    ok = F.trim(F.col(line_col)) == F.lit(",".join(expected))
    return first_lines.withColumn("header_ok", F.coalesce(ok, F.lit(False)))


def landed_bodies(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file_path, body): one row per landed file, the whole file as text.

    For API responses (one JSON document per file, bounded by the API's page
    size); large exports should be read with the CSV/JSON readers instead.
    """
    return spark.read.option("wholetext", True).text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body"))


def file_stem(path_col: Column) -> Column:
    """``/landing/x/PKO.csv`` -> ``PKO``."""
    return F.regexp_extract(path_col, r"([^/]+?)(\.[^./]*)?$", 1)


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file_path, first_line) per landed text file, read on executors.

    Only each file's first split is considered; row order inside a split is
    the scan order, captured by ``monotonically_increasing_id``.
    """
    t = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("__b"),
        "value", F.monotonically_increasing_id().alias("__i"))
    return t.where(F.col("__b") == 0).groupBy("file_path").agg(F.min_by("value", "__i").alias("first_line"))


# ---- A03/A04: FX and macro JSON ------------------------------------------------------

def fx_rows_from_json(df: DataFrame, payload_col: str, source: str | Column, retrieved_at) -> DataFrame:
    """``{code, rates:[{effectiveDate, mid}]}`` bodies -> Bronze FX rows."""
    p = df.select(F.from_json(F.col(payload_col), FX_PAYLOAD).alias("p"))
    rows = p.select(F.col("p.code").alias("currency_code"), F.explode("p.rates").alias("r")).select(
        "currency_code", F.col("r.effectiveDate").alias("effective_date"), F.col("r.mid").alias("mid_rate"))
    return provenance(rows, source, retrieved_at)


def macro_rows_from_json(df: DataFrame, payload_col: str, indicator_name: Column | str,
                         variable_id: Column | int, unit: Column | str | None, source: str | Column,
                         retrieved_at) -> DataFrame:
    """``{results:[{values:[{year, val}]}]}`` bodies -> Bronze macro rows.

    A body without ``results`` (or with empty ``values``) yields no row; a
    null ``val`` is kept; the text year becomes int (bad text -> null).
    """
    def lit_or_col(x, name):
        return F.col(x) if isinstance(x, str) and x in df.columns else (x if isinstance(x, Column) else F.lit(x))
    base = df.select(lit_or_col(indicator_name, "indicator_name").alias("indicator_name"),
                     lit_or_col(variable_id, "variable_id").cast("int").alias("variable_id"),
                     lit_or_col(unit, "unit").cast("string").alias("unit"),
                     F.from_json(F.col(payload_col), MACRO_PAYLOAD).alias("p"))
    rows = (base.select("indicator_name", "variable_id", "unit", F.explode("p.results").alias("res"))
            .select("indicator_name", "variable_id", "unit", F.explode("res.values").alias("v"))
            .select("indicator_name", "variable_id", F.col("v.year").try_cast("int").alias("year"),
                    F.col("v.val").alias("value"), "unit"))
    return provenance(rows, source, retrieved_at)


# ---- A05: statement JSON arrays, inferred field union ---------------------------------

def read_statement_json(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False
                        ) -> DataFrame:
    """Landed statement records -> wide rows with the inferred field union.

    Absent keys are null, an all-null field is a string column, int and float
    mixes widen to double. JSON-lines by default; ``multi_line`` for files
    holding one JSON array each. Raises on an input with no records.
    """
    df = spark.read.option("multiLine", multi_line).json(path)
    if not df.columns or df.columns == ["_corrupt_record"]:
        raise EmptyBatchError("the landed statement files hold no record")
    return df


def statement_record_maps(df: DataFrame, body_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON-array bodies -> one row per record, its fields as ``payload`` map<string,string>
    (the literal text of each value). Every body is parsed once; bodies that are not arrays
    yield no row."""
    records = F.from_json(F.col(body_col), "array<map<string,string>>")
    return df.select(*keep, F.posexplode(records).alias("record_pos", "payload"))


def statement_records(df: DataFrame, body_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON-array bodies -> one row per record, the record kept as a VARIANT
    ``payload`` (stored natively by Parquet): a schema-free Bronze that needs
    no inference pass and never drifts in type. Bodies that are not arrays
    yield no row (guard them with :func:`classify_payload` first).
    """
    # no isNotNull filter: variant_explode(NULL) yields no row, and a filter
    # would make the optimizer parse every body twice
    v = df.select(*keep, F.try_parse_json(F.col(body_col)).alias("__v"))
    e = v.lateralJoin(v.sparkSession.tvf.variant_explode(F.col("__v").outer())
                      .select(F.col("pos").alias("record_pos"), F.col("value").alias("payload")), how="inner")
    return e.select(*keep, "record_pos", "payload")


# ---- A06: payload-shape guards --------------------------------------------------------

def classify_payload(body: Column, expect: str) -> Column:
    """Status of a landed body: ``ok``, ``empty``, ``html``, ``not_json``,
    ``not_json_array`` (``expect`` is ``csv`` or ``json_array``)."""
    # whitespace is any of space, tab, CR, LF, FF (not only spaces, unlike trim())
    base = F.when(body.isNull() | body.rlike(r"^\s*$"), "empty").when(body.rlike(r"^\s*<"), "html")
    if expect == "csv":
        return base.otherwise("ok")
    v = F.try_parse_json(body)
    return (base.when(v.isNull(), "not_json")
            .when(~F.schema_of_variant(v).startswith("ARRAY"), "not_json_array").otherwise("ok"))


def split_payloads(df: DataFrame, body_col: str, expect: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) bodies with a ``payload_status`` column."""
    s = df.withColumn("payload_status", classify_payload(F.col(body_col), expect))
    return s.where(F.col("payload_status") == "ok"), s.where(F.col("payload_status") != "ok")


# ---- A07: empty-batch policy ----------------------------------------------------------

def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise :class:`EmptyBatchError` when ``df`` is empty (one cheap job)."""
    if df.isEmpty():
        raise EmptyBatchError(f"no rows produced for {what}")
    return df


def batch_status(rows: DataFrame, key: str, expected: DataFrame, accepted: Column | None = None) -> DataFrame:
    """(key, ``n_rows``, ``n_accepted``, ``refused``) of every expected batch, in one aggregate.

    ``expected`` lists the batches (a column named ``key``); one that landed nothing is there
    with zeros. A batch is refused as empty when no row of it is ``accepted`` (default: any row
    is). Batches that nobody expects are listed too; a null key is none.
    """
    ok = F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False))
    found = (rows.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_accepted")))
    names = expected.select(key).where(F.col(key).isNotNull()).distinct()
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_accepted")}
    return (names.join(found, key, "full_outer").select(key, *zero.values())
            .withColumn("refused", F.col("n_accepted") == 0))


def require_batches(status: DataFrame, key: str) -> None:
    """Raise :class:`EmptyBatchError` naming the first refused batches (at most ten) of :func:`batch_status`."""
    bad = [str(r[0]) for r in status.where("refused").orderBy(key).select(key).limit(10).collect()]
    if bad:
        raise EmptyBatchError("no rows produced for " + ", ".join(bad))
