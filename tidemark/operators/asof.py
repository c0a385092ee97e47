"""As-of join on any ordered column, in range partitions.

Both sides are laid out together by (key, time) over range partitions, so a key that holds a
third of all rows fills many of them. Inside a partition each left row takes the last right
row before it; a small summary carries the last right row of each partition to those that
follow with the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import fresh_dir


def asof_join_sorted(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
                     values: Sequence[str], tolerance: str | None = None, partitions: int | None = None) -> DataFrame:
    """Left as-of join: each left row gets the latest right row of its ``by`` group with ``right_on <= left_on``.

    For timestamps and numbers alike (dates too; :func:`tidemark.operators.joins.asof_join`
    is for dates only). ``tolerance`` (an interval such as ``'2 hours'``) leaves out right
    rows that are older. The columns of ``left`` come back with ``values`` of the matched
    row and its time as ``matched_<right_on>``; all are null where nothing matches. Of right
    rows at one time the greatest by ``values`` counts. A null key or time on the left
    matches nothing; such rows on the right are left out. Left rows are never lost, and
    equal rows stay apart.

    The two sides are written once to the shared work folder, in order; the summary has a
    row for each (partition, key) at most.
    """
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    keys = [f"__k{i}" for i in range(len(by))]
    taken = F.struct(F.col(f"`{right_on}`").alias("t"), *[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)])
    payload = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(left.columns)])
    found = right.dropna(subset=[*by, right_on]).select(
        *[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys, strict=True)], F.col(f"`{right_on}`").alias("__t"), F.lit(0).alias("__left"),
        taken.alias("__r"))
    kind = found.schema["__r"].dataType
    asked = left.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys, strict=True)], F.col(f"`{left_on}`").alias("__t"),
                        F.lit(1).alias("__left"), F.lit(None).cast(kind).alias("__r"), payload.alias("__l"),
                        F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]).alias("__spread"))
    # right rows come before left rows of the same time, the greatest of them last; many left rows of one time are spread
    order = [*keys, "__t", "__left", "__r", "__spread"]
    laid = (found.unionByName(asked, allowMissingColumns=True).repartitionByRange(n, *order)
            .sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()))
    at = fresh_dir(spark, "asof")
    laid.write.parquet(at)
    laid = spark.read.schema(laid.schema).parquet(at)

    # what each partition leaves to the next ones: rows come in (key, time) order, so its greatest right row
    leaves = laid.where("__left = 0").groupBy("__p", *keys).agg(F.max("__r").alias("__last"))
    starts = laid.where("__left = 1").select("__p", *keys).distinct()
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carried = (starts.join(leaves, ["__p", *keys], "full_outer")
               .withColumn("__carry", F.last("__last", ignorenulls=True).over(before)).select("__p", *keys, "__carry")
               .where("__carry is not null"))
    local = Window.partitionBy("__p", *keys).orderBy("__t", "__left", "__r").rowsBetween(Window.unboundedPreceding, 0)
    rows = laid.withColumn("__m", F.last("__r", ignorenulls=True).over(local)).where("__left = 1")
    out = rows.join(carried, ["__p", *keys], "left")
    match = F.coalesce("__m", "__carry")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    known = known & F.col("__t").isNotNull()
    if tolerance is not None:
        known = known & (match["t"] >= F.col("__t") - F.expr(f"INTERVAL {tolerance}"))
    match = F.when(known, match)
    return out.select(*[F.col(f"__l.c{i}").alias(c) for i, c in enumerate(left.columns)],
                      *[match[f"v{i}"].alias(v) for i, v in enumerate(values)], match["t"].alias(f"matched_{right_on}"))
