"""Keyed merge into Spark's own bucketed tables: the join moves the increment only.

A table that is bucketed by its merge key is read bucket by bucket, so the full outer join
of the merge exchanges the source and leaves the target where it is. Each merge writes a
new bucketed table and moves the table's view to it, which the catalog does at once;
readers see the old or the new rows. One writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import assert_unique
from tidemark.session import fresh_dir
from tidemark.sinks.upsert import merged


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _backing(spark: SparkSession, view: str) -> tuple[str, int]:
    """The bucketed table that a view shows, and its buckets."""
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(view)}").collect()}
    return props["tidemark.table"], int(props["tidemark.buckets"])


def _write(df: DataFrame, view: str, keys: Sequence[str], buckets: int) -> None:
    spark = df.sparkSession
    table = f"{view}_{uuid.uuid4().hex[:12]}"
    # rows arrive by bucket, so a bucket is one file
    (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", fresh_dir(spark, "bucketed", table.replace(".", "_")))
     .saveAsTable(_quoted(table)))
    properties = f"'tidemark.table' = '{table}', 'tidemark.buckets' = '{buckets}'"
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(view)} TBLPROPERTIES ({properties}) AS SELECT * FROM {_quoted(table)}")


def merge_plan(spark: SparkSession, source: DataFrame, view: str, keys: Sequence[str],
               newer_wins: str | Sequence[str] | None = None) -> DataFrame:
    """The merged rows; in the plan, only the source is exchanged."""
    table, buckets = _backing(spark, view)
    dealt = source.repartition(buckets, *keys)
    return merged(spark.table(_quoted(table)), dealt, keys, newer_wins)


def merge_bucketed(spark: SparkSession, source: DataFrame, view: str, keys: Sequence[str], buckets: int | None = None,
                   newer_wins: str | Sequence[str] | None = None) -> None:
    """Merge ``source`` into the table behind ``view``, created on the first run with ``buckets`` buckets.

    The semantics are those of :func:`tidemark.sinks.upsert.upsert`: matched rows are
    replaced, others inserted, nothing is deleted, a null key matches nothing, duplicate
    source keys raise, ``newer_wins`` skips older source rows, new columns are added. Choose at least as many
    buckets as ``spark.sql.shuffle.partitions`` (the default), or Spark deals both sides anew;
    a bucket should fit a task many times over its final size.
    """
    staged_at = fresh_dir(spark, "bucketed-source")
    source.write.parquet(staged_at)
    staged = spark.read.schema(source.schema).parquet(staged_at)
    assert_unique(staged.dropna(subset=list(keys)), list(keys), "source")
    if not spark.catalog.tableExists(view):
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        _write(staged.repartition(n, *keys), view, keys, n)
        return
    old, n = _backing(spark, view)
    _write(merge_plan(spark, staged, view, keys, newer_wins), view, keys, n)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(old)}")
