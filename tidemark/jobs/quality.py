"""Reconciliation job: the fourteen layer checks as one plan and one action."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.jobs.lake import Lake
from tidemark.jobs.silver import bronze_statements
from tidemark.operators.gold import build_fact_fundamentals, build_fact_macro, build_fact_prices
from tidemark.operators.quality import Check, raise_on_failure, run_suite
from tidemark.operators.reconcile import compare_content, content_diff
from tidemark.schemas import KEYS
from tidemark.sinks.tables import append, read_appended

# The names of the contract's checks.
CHECKS = [
    Check("prices_bronze_to_silver_count", "count_loose", "bronze_prices", "silver_prices"),
    Check("prices_bronze_to_silver_range", "range", "bronze_prices", "silver_prices", "date", "date"),
    Check("fx_rates_bronze_to_silver_count", "count_loose", "bronze_fx", "silver_fx"),
    Check("fx_rates_bronze_to_silver_range", "range", "bronze_fx", "silver_fx", "effective_date", "effective_date"),
    # compared at statement grain: Silver is long (one row per metric)
    Check("fundamentals_bronze_to_silver_count", "count_loose", "bronze_fundamentals", "silver_statements"),
    Check("fundamentals_bronze_to_silver_range", "range", "bronze_fundamentals", "silver_fundamentals", "date",
          "period_end_date"),
    Check("macro_bronze_to_silver_count", "count_loose", "bronze_macro", "silver_macro"),
    Check("macro_bronze_to_silver_range", "range", "bronze_macro", "silver_macro", "year", "year"),
    Check("prices_silver_to_gold_count", "count_exact", "silver_prices", "fact_prices"),
    Check("prices_silver_to_gold_range", "range", "silver_prices", "fact_prices", "date", "date"),
    Check("fundamentals_silver_to_gold_count", "count_exact", "silver_fundamentals", "fact_fundamentals"),
    Check("fundamentals_silver_to_gold_range", "range", "silver_fundamentals", "fact_fundamentals",
          "period_end_date", "period_end_date"),
    Check("macro_silver_to_gold_count", "count_exact", "silver_macro", "fact_macro"),
    Check("macro_silver_to_gold_range", "range", "silver_macro", "fact_macro", "reference_date", "reference_date"),
]


def reconciliation_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The layer tables the checks read, each referenced once."""
    sf = lake.read(spark, "silver_fundamentals")
    return {
        "bronze_prices": lake.read_bronze(spark, "bronze_stooq_prices"),
        "silver_prices": lake.read(spark, "silver_prices"),
        "fact_prices": lake.read(spark, "fact_prices"),
        "bronze_fx": lake.read_bronze(spark, "bronze_nbp_fx_rates"),
        "silver_fx": lake.read(spark, "silver_fx_rates"),
        "bronze_fundamentals": bronze_statements(spark, lake),
        "silver_fundamentals": sf,
        "silver_statements": sf.select("ticker", "period_end_date", "statement_type", "period_type").distinct(),
        "fact_fundamentals": lake.read(spark, "fact_fundamentals"),
        "bronze_macro": lake.read_bronze(spark, "bronze_gus_macro"),
        "silver_macro": lake.read(spark, "silver_macro"),
        "fact_macro": lake.read(spark, "fact_macro"),
    }


def run_reconciliation(spark: SparkSession, lake: Lake, raise_on_fail: bool = True) -> DataFrame:
    """Compute the checks once (written with a run id and time to
    ``quality_reconciliation``), then raise when any failed."""
    run = uuid.uuid4().hex
    results = (run_suite(reconciliation_tables(spark, lake), CHECKS).withColumn("run_id", F.lit(run))
               .withColumn("checked_at", F.current_timestamp()))
    append(results, lake.path("quality_reconciliation"))
    own = read_appended(spark, lake.path("quality_reconciliation")).where(F.col("run_id") == run)
    if raise_on_fail:
        raise_on_failure(own)
    return own


#: Gold tables that hold the rows of a Silver table, projected
MIRRORS = {"fact_prices": ("silver_prices", build_fact_prices), "fact_fundamentals": ("silver_fundamentals", build_fact_fundamentals),
           "fact_macro": ("silver_macro", build_fact_macro)}


def run_content_reconciliation(spark: SparkSession, lake: Lake, raise_on_fail: bool = True) -> DataFrame:
    """Compare the rows of every Gold fact with its Silver table, beyond counts and ranges.

    One check row per table goes to ``quality_reconciliation`` and the keys that differ, as
    JSON with their status and columns, to ``quality_content_diff``, both under a run id.
    Raises when any table differs. Returns the check rows.
    """
    run, at = uuid.uuid4().hex, F.current_timestamp()
    checks = diffs = None
    for table, (silver, build) in MIRRORS.items():
        source, target = build(lake.read(spark, silver)), lake.read(spark, table)
        keys, columns = KEYS[table], target.columns
        check = compare_content(source, target, keys, columns, f"{table}_content")
        diff = content_diff(source, target, keys, columns)
        diff = diff.select(F.lit(table).alias("table"), F.to_json(F.struct(*keys)).alias("key"), "status", "n_source", "n_target",
                           "changed_columns")
        checks = check if checks is None else checks.unionByName(check)
        diffs = diff if diffs is None else diffs.unionByName(diff)
    append(checks.withColumn("ordinal", F.lit(len(CHECKS))).withColumn("run_id", F.lit(run)).withColumn("checked_at", at),
           lake.path("quality_reconciliation"))
    own = read_appended(spark, lake.path("quality_reconciliation")).where(F.col("run_id") == run)
    if not own.where(~F.col("passed")).isEmpty():
        append(diffs.withColumn("run_id", F.lit(run)), lake.path("quality_content_diff"))
    if raise_on_fail:
        raise_on_failure(own)
    return own
