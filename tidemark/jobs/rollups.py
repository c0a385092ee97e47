"""Facts and their monthly rollup advanced together by increments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.deltas import WEIGHT, apply_deltas, change_images, rollup_deltas
from tidemark.jobs.lake import Lake
from tidemark.operators.gold import build_fact_prices
from tidemark.schemas import KEYS
from tidemark.session import fresh_dir
from tidemark.sinks.upsert import _fs, committed_versions, read_current, table_exists, upsert

#: the version of the facts that a row of a rollup has seen
APPLIED = "facts_version"


def _changes_path(facts: str, version: int) -> str:
    return f"{facts.rstrip('/')}_changes/facts_version={version}"


def merge_facts(spark: SparkSession, source: DataFrame, facts: str, keys: Sequence[str],
                newer_wins: str | Sequence[str] | None = None) -> int:
    """Merge ``source`` into the facts at ``facts`` and keep the merge's images beside them; returns the version.

    The images are written before the facts, under the version that the merge will have, so
    a merge that is run again after a crash writes the same images again. One writer per table.
    """
    staged_at = fresh_dir(spark, "facts-increment")
    source.write.parquet(staged_at)
    staged = spark.read.schema(source.schema).parquet(staged_at)
    versions = committed_versions(spark, facts)
    target = read_current(spark, facts) if versions else None
    version = (versions[-1] if versions else 0) + 1
    change_images(target, staged, keys, newer_wins).write.mode("overwrite").parquet(_changes_path(facts, version))
    return upsert(spark, staged, facts, keys, newer_wins=newer_wins)


def refresh_rollup(spark: SparkSession, facts: str, rollup: str, groups: Mapping[str, Column], sums: Mapping[str, Column]) -> int:
    """Bring the rollup at ``rollup`` up to the facts' version by the images of the merges it has not seen.

    Versions are applied one by one and every group remembers the last it has seen, so a
    refresh that is run again changes nothing. A rollup that does not exist yet, or that has
    to pass a version whose merge left no images (a plain upsert), is built from all facts.
    Returns the versions applied.
    """
    versions = committed_versions(spark, facts)
    exists = table_exists(spark, rollup)
    seen = (read_current(spark, rollup).agg(F.max(APPLIED)).first()[0] or 0) if exists else 0
    todo = list(range(seen + 1, (versions[-1] if versions else 0) + 1))
    if not todo:
        return 0
    if not exists or any(not _exists(spark, _changes_path(facts, v)) for v in todo):
        _put(spark, rollup, _rebuilt(spark, facts, rollup if exists else None, groups, sums), groups, todo[-1])
        return len(todo)
    for version in todo:
        deltas = rollup_deltas(spark.read.parquet(_changes_path(facts, version)), groups, sums)
        _put(spark, rollup, apply_deltas(read_current(spark, rollup), deltas, list(groups), list(sums)), groups, version)
    return len(todo)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _rebuilt(spark: SparkSession, facts: str, rollup: str | None, groups: Mapping[str, Column], sums: Mapping[str, Column]) -> DataFrame:
    """All groups of the facts, and those that only an older rollup has, without rows."""
    new = apply_deltas(None, rollup_deltas(read_current(spark, facts).withColumn(WEIGHT, F.lit(1)), groups, sums), list(groups), list(sums))
    if rollup is None:
        return new
    old = read_current(spark, rollup).select(*[F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(groups)])
    gone = old.join(new, [F.col(f"__g{i}").eqNullSafe(F.col(f"`{g}`")) for i, g in enumerate(groups)], "left_anti")
    return new.unionByName(gone.select(*[F.col(f"__g{i}").alias(g) for i, g in enumerate(groups)],
                                       *[F.lit(0).cast(new.schema[c].dataType).alias(c) for c in ("n_rows", *sums)]))


def _put(spark: SparkSession, rollup: str, rows: DataFrame, groups: Mapping[str, Column], version: int) -> None:
    # null groups are values here, and an upsert's null key matches nothing
    keyed = rows.withColumn(APPLIED, F.lit(version)).withColumn("__group", F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}))
    upsert(spark, keyed, rollup, ["__group"])


def read_rollup(spark: SparkSession, rollup: str) -> DataFrame:
    """The groups that have rows."""
    return read_current(spark, rollup).where("n_rows > 0").drop("__group", APPLIED)


#: the monthly rollup of the price facts, by currency
PRICES_MONTHLY = "fact_prices_monthly"


def advance_fact_prices(spark: SparkSession, lake: Lake, since=None) -> int:
    """Merge Silver prices (those retrieved on or after ``since``) into ``fact_prices`` and advance its monthly rollup.

    For tables in snapshots; returns the versions that the rollup took.
    """
    if lake.catalog or "fact_prices" in lake.partitioned:
        raise ValueError("maintained rollups need fact_prices as snapshots")
    silver = lake.read(spark, "silver_prices")
    if since is not None:
        silver = silver.where(F.col("retrieved_at") >= F.to_timestamp(F.lit(str(since))))
    facts = lake.path("fact_prices")
    merge_facts(spark, build_fact_prices(silver), facts, KEYS["fact_prices"], newer_wins="retrieved_at")
    groups = {"currency": F.col("currency"), "year": F.year("date"), "month": F.month("date")}
    return refresh_rollup(spark, facts, lake.path(PRICES_MONTHLY), groups, {"sum_close": F.col("close").cast("decimal(18,4)"),
                                                                            "sum_volume": F.col("volume")})
