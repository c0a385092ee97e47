"""Bronze ingestion jobs: landed API payloads -> append-only raw tables.

One multi-file scan per source replaces per-request loops; bad payloads are
quarantined with a reason (in ``<table>_quarantine`` or ``<table>_bodies_quarantine``)
instead of failing the batch,
and a batch that yields no row at all raises :class:`EmptyBatchError`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.jobs.lake import BRONZE_PARTITION, STATEMENT_TYPES, Lake
from tidemark.operators.quality import fx_rules, price_rules
from tidemark.schemas import BRONZE_PRICES, STATEMENT_ENVELOPE_COLUMNS
from tidemark.session import fresh_dir
from tidemark.sinks.tables import append
from tidemark.sources import landed


def _settle(lake: Lake, table: str, rows: DataFrame, what: str) -> int:
    """Write ``rows`` by their ``reject_reason``: null goes to the table, anything else to its quarantine.

    The rows are evaluated once, into the shared work folder, so what is accepted and what
    is quarantined add up to what was landed. Returns the accepted rows; a batch with
    none of them raises after the rejects are stored.
    """
    spark = rows.sparkSession
    folder = fresh_dir(spark, "bronze-stage")
    rows.write.parquet(folder)
    staged = spark.read.schema(rows.schema).parquet(folder)
    counts = {r["reject_reason"]: r["count"] for r in staged.groupBy("reject_reason").count().collect()}
    if any(k is not None for k in counts):
        bad = staged.where(F.col("reject_reason").isNotNull())
        append(bad.withColumn("quarantined_at", F.current_timestamp()), lake.path(f"{table}_quarantine"))
    n = counts.get(None, 0)
    if n == 0:
        raise landed.EmptyBatchError(f"no rows produced for {what}")
    drop = ["reject_reason", *[c for c in ("landed_file", "raw") if c in rows.columns]]
    lake.append_bronze(staged.where(F.col("reject_reason").isNull()).drop(*drop), table)
    return n


def _rule_reason(rules) -> Column:
    """The names of the broken rules, or null."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return F.when(F.size(broken) > 0, F.concat(F.lit("rules: "), F.array_join(broken, ", ")))


def ingest_prices(spark: SparkSession, lake: Lake, landing: str, tickers: DataFrame, retrieved_at,
                  source: str = "stooq", validate: bool = True) -> int:
    """Daily OHLCV CSV files (``<stooq_symbol>.csv``) -> ``bronze_stooq_prices``.

    Rows of files with an unexpected header or an unknown symbol, rows that do not parse
    or have no date and (with ``validate``) rows breaking the price rules (low <= open,
    close <= high, volume >= 0) go to ``bronze_stooq_prices_quarantine`` with the
    reason, as do files that hold a wrong header and no row. Returns the appended rows.
    """
    headers = landed.csv_header_status(landed.first_lines(spark, landing)).withColumnRenamed("file_path", "landed_file")
    rows = landed.read_price_csv(spark, landing, tickers, source, retrieved_at).join(headers, "landed_file", "full_outer")
    no_row = F.col("retrieved_at").isNull()
    reason = (F.when(~F.coalesce("header_ok", F.lit(False)), "header")
              .when(F.col("_corrupt_record").isNotNull(), "row does not parse")
              .when(F.col("ticker").isNull(), "unknown symbol"))
    if validate:
        reason = F.coalesce(reason, _rule_reason(price_rules()))
    rows = rows.where(~no_row | ~F.col("header_ok"))  # a good file without rows has nothing to tell
    raw = F.coalesce("_corrupt_record", F.when(no_row, F.col("first_line")))
    cols = [f.name for f in BRONZE_PRICES.fields]
    return _settle(lake, "bronze_stooq_prices", rows.select(*cols, "landed_file", raw.alias("raw"),
                                                            reason.alias("reject_reason")), "stooq prices")


def _settle_bodies(lake: Lake, table: str, bodies: DataFrame, reason: Column) -> DataFrame:
    """Store rejected bodies with their reason; the others go on."""
    judged = bodies.withColumn("reject_reason", reason)
    spark = bodies.sparkSession
    folder = fresh_dir(spark, "bronze-bodies")
    judged.write.parquet(folder)
    judged = spark.read.schema(judged.schema).parquet(folder)
    bad = judged.where(F.col("reject_reason").isNotNull())
    if bad.limit(1).count():
        append(bad.withColumn("quarantined_at", F.current_timestamp()), lake.path(f"{table}_bodies_quarantine"))
    return judged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def _object_reason(body: Column, field: str) -> Column:
    """Why a body is no JSON object with ``field``; null when it is one."""
    v = F.try_parse_json(body)
    status = landed.classify_payload(body, "csv")
    return (F.when(status != "ok", status).when(v.isNull(), "not_json")
            .when(~F.schema_of_variant(v).startswith("OBJECT"), "not_json_object")
            .when(F.try_variant_get(v, f"$.{field}", "variant").isNull(), f"no_{field}"))


def ingest_fx(spark: SparkSession, lake: Lake, landing: str, retrieved_at, source: str = "nbp",
              validate: bool = True) -> int:
    """FX rate payloads (one JSON object per file) -> ``bronze_nbp_fx_rates``.

    Bodies that are not JSON objects with rates, and (with ``validate``) rates that are
    not positive, are quarantined with a reason."""
    bodies = landed.landed_bodies(spark, landing)
    ok = _settle_bodies(lake, "bronze_nbp_fx_rates", bodies, _object_reason(F.col("body"), "rates"))
    out = landed.fx_rows_from_json(ok, "body", source, retrieved_at)
    reason = _rule_reason(fx_rules()) if validate else F.lit(None).cast("string")
    return _settle(lake, "bronze_nbp_fx_rates", out.withColumn("reject_reason", reason), "nbp rates")


def ingest_macro(spark: SparkSession, lake: Lake, landing: str, indicators: DataFrame, retrieved_at,
                 source: str = "gus") -> int:
    """Macro payloads named ``<variable_id>_<year>.json`` -> ``bronze_gus_macro``.

    Indicator name and unit come from the indicator reference table joined on the
    variable id in the file name. Bodies that are not JSON objects, and files whose id
    has no indicator, are quarantined with a reason; an object without results is a
    valid answer with no row.
    """
    bodies = landed.landed_bodies(spark, landing).withColumn(
        "gus_variable_id", F.split(landed.file_stem(F.col("file_path")), "_").getItem(0).try_cast("int"))
    ref = indicators.select("gus_variable_id", F.col("name").alias("indicator_name"), "unit")
    j = bodies.join(ref, "gus_variable_id", "left")
    shape = _object_reason(F.col("body"), "results")
    reason = F.coalesce(F.when(shape != "no_results", shape), F.when(F.col("indicator_name").isNull(), "unknown indicator"))
    ok = _settle_bodies(lake, "bronze_gus_macro", j, reason)
    out = landed.macro_rows_from_json(ok, "body", F.col("indicator_name"), F.col("gus_variable_id"), F.col("unit"),
                                      source, retrieved_at)
    return _settle(lake, "bronze_gus_macro", out.withColumn("reject_reason", F.lit(None).cast("string")), "gus macro")


def ingest_statements(spark: SparkSession, lake: Lake, landing: str, statement_type: str, retrieved_at,
                      source: str = "fmp") -> None:
    """Statement payloads (``<ticker>.json``, a JSON array each) -> one Bronze
    table per statement type, schema inferred from the field union and
    appended with additive schema evolution."""
    from tidemark.functions.columns import provenance
    bodies = landed.landed_bodies(spark, landing)
    status = landed.classify_payload(F.col("body"), "json_array")
    ok = _settle_bodies(lake, STATEMENT_TYPES[statement_type], bodies, F.when(status != "ok", status))
    # accepted bodies become one record a line, each with its ticker, for the inferring reader
    folder = fresh_dir(spark, "statement-records")
    records = landed.statement_records(ok.withColumn("ticker", landed.file_stem(F.col("file_path"))), "body",
                                       keep=["ticker"])
    # the ticker comes last, so it wins over a field of that name
    fields = F.to_json("payload")
    records.select(F.concat(F.expr("left(to_json(payload), length(to_json(payload)) - 1)"),
                            F.when(fields == "{}", "").otherwise(","),
                            F.substr(F.to_json(F.struct("ticker")), F.lit(2))).alias("value")).write.text(folder)
    wide = landed.read_statement_json(spark, folder)
    metrics = [c for c in wide.columns if c not in set(STATEMENT_ENVELOPE_COLUMNS)]
    append(provenance(wide, source, retrieved_at).withColumn(BRONZE_PARTITION, F.to_date("retrieved_at")),
           lake.path(STATEMENT_TYPES[statement_type]), [BRONZE_PARTITION], numbers_as_double=metrics)


def ingest_statement_payloads(spark: SparkSession, lake: Lake, landing: str, statement_type: str, retrieved_at,
                              source: str = "fmp") -> int:
    """Schema-free alternative to :func:`ingest_statements`: one row per
    record with the record kept as a VARIANT ``payload`` in
    ``<table>_payload``. No inference pass, no type drift between runs."""
    from tidemark.functions.columns import provenance
    bodies = landed.landed_bodies(spark, landing)
    status = landed.classify_payload(F.col("body"), "json_array")
    table = STATEMENT_TYPES[statement_type] + "_payload"
    ok = _settle_bodies(lake, table, bodies, F.when(status != "ok", status))
    recs = landed.statement_records(
        ok.withColumn("ticker", landed.file_stem(F.col("file_path"))).withColumn("statement_type",
                                                                                F.lit(statement_type)),
        "body", keep=["ticker", "statement_type"])
    return _settle(lake, table, provenance(recs, source, retrieved_at).withColumn(
        "reject_reason", F.lit(None).cast("string")), f"{statement_type} payloads")


# ---- request plans: what the fetchers should land (A11/A12) -----------------------------

def fx_request_plan(currencies: DataFrame, start, end, max_days: int | None = None) -> DataFrame:
    """(code, chunk_start, chunk_end): every currency x request chunk of at most
    ``max_days`` (the FX source's per-request limit) covering [start, end]."""
    from tidemark.operators.calendar import chunk_ranges
    from tidemark.schemas import FX_MAX_RANGE_DAYS
    ranged = currencies.select("code", F.to_date(F.lit(str(start))).alias("__s"),
                               F.to_date(F.lit(str(end))).alias("__e"))
    return chunk_ranges(ranged, "__s", "__e", max_days or FX_MAX_RANGE_DAYS).select("code", "chunk_start",
                                                                                   "chunk_end")


def macro_request_plan(indicators: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """(name, gus_variable_id, unit, year): every indicator x year."""
    from tidemark.operators.calendar import year_grid
    return year_grid(indicators, first_year, last_year).select("name", "gus_variable_id", "unit", "year")


def statement_request_plan(tickers: DataFrame) -> DataFrame:
    """(ticker, fmp_symbol, statement_type): every listed ticker x statement type."""
    types = F.array(*[F.lit(t) for t in STATEMENT_TYPES])
    return tickers.where(F.col("fmp_symbol").isNotNull()).select(
        "ticker", "fmp_symbol", F.explode(types).alias("statement_type"))
