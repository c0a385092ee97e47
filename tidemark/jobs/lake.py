"""Table layout of the lakehouse (one folder per table under a root)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.tables import append, read_appended
from tidemark.sinks.upsert import (
    merge_into_catalog,
    partitioned_exists,
    read_current,
    read_partitioned,
    recover_partitioned,
    table_exists,
    upsert,
    upsert_partitions,
)

BRONZE_PARTITION = "retrieved_date"

BRONZE_TABLES = ["bronze_stooq_prices", "bronze_nbp_fx_rates", "bronze_gus_macro", "bronze_fmp_balance_sheet",
                 "bronze_fmp_income_statement", "bronze_fmp_cash_flow"]
STATEMENT_TYPES = {"balance_sheet": "bronze_fmp_balance_sheet",
                   "income_statement": "bronze_fmp_income_statement",
                   "cash_flow": "bronze_fmp_cash_flow"}


@dataclass(frozen=True)
class Lake:
    """Tables live at ``<root>/<name>``; the root is a shared folder (HDFS,
    object store) on a cluster.

    ``partitioned`` maps a Silver/Gold table to partition columns (part of
    its key); such tables are upserted partition by partition, the others as
    whole snapshots. ``catalog`` names a namespace whose tables support MERGE
    (a row-level table format): Silver and Gold are then read and merged there by
    table name.
    """
    root: str
    partitioned: dict = field(default_factory=dict)
    catalog: str | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # Bronze: append-only, partitioned by retrieval day -------------------------------
    def append_bronze(self, df: DataFrame, table: str) -> None:
        append(df.withColumn(BRONZE_PARTITION, F.to_date("retrieved_at")), self.path(table), [BRONZE_PARTITION])

    def compact_bronze(self, spark: SparkSession, table: str, day=None) -> int:
        """Rewrite Bronze retrieval-day partitions (all, or one ``day``) into
        advisory-sized files; rows are unchanged."""
        from tidemark.sinks.upsert import compact_partitions
        where = None if day is None else (F.col(BRONZE_PARTITION) == F.to_date(F.lit(str(day))))
        return compact_partitions(spark, self.path(table), [BRONZE_PARTITION], where)

    def read_bronze(self, spark: SparkSession, table: str, since=None) -> DataFrame:
        """Full read, or only retrievals on/after ``since`` (prunes partitions)."""
        df = read_appended(spark, self.path(table))
        if since is not None:
            df = df.where(F.col(BRONZE_PARTITION) >= F.to_date(F.lit(str(since))))
        return df.drop(BRONZE_PARTITION)

    # Silver / Gold: upserted snapshots ----------------------------------------------------
    def upsert(self, spark: SparkSession, df: DataFrame, table: str, keys, newer_wins: str | None = None) -> int:
        if self.catalog:
            merge_into_catalog(df, f"{self.catalog}.{table}", keys, newer_wins)
            return 0
        if table in self.partitioned:
            return upsert_partitions(spark, df, self.path(table), keys, self.partitioned[table],
                                     newer_wins=newer_wins)
        return upsert(spark, df, self.path(table), keys, newer_wins=newer_wins)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.catalog:
            return spark.table(f"{self.catalog}.{table}")
        if table in self.partitioned:
            return read_partitioned(spark, self.path(table))
        return read_current(spark, self.path(table))

    def exists(self, spark: SparkSession, table: str) -> bool:
        if self.catalog:
            return spark.catalog.tableExists(f"{self.catalog}.{table}")
        if table in self.partitioned:
            recover_partitioned(spark, self.path(table))
            return partitioned_exists(spark, self.path(table))
        return table_exists(spark, self.path(table))
