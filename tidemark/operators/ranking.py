"""Exact ``rank()`` inside groups that may be too large for one task.

A window ``PARTITION BY group`` sends a whole group to one task; a peer group
that holds a third of all rows would then sort a third of the data in one
place. Here rows are first counted per distinct (group, value), which combines
before the shuffle, so a value that a third of a group shares is one row. The
distinct values are range-partitioned on (group, value), and

    rank = 1 + (rows of the group in earlier range partitions)
             + (rows of the group with a better value in this partition)

Both terms are running sums of counts; ranks are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import fresh_dir


def grouped_rank(df: DataFrame, group_cols: Sequence[str], order_col: str, out_col: str = "rank",
                 descending: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = ``rank() OVER (PARTITION BY group_cols ORDER BY order_col)`` (bigint).

    Nulls in ``order_col`` sort last in both directions; NaN sorts above all numbers;
    ties share a rank and leave gaps, like ``rank()``. A null group is a group of its
    own. Columns keep their types and values. ``df`` is evaluated once, into the shared
    work folder, as it is read for the counts and for the rows.
    """
    spark = df.sparkSession
    rows = fresh_dir(spark, "rank-rows")
    df.write.parquet(rows)
    df = spark.read.schema(df.schema).parquet(rows)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = [f"__tm_g{i}" for i in range(len(group_cols))]
    o = F.col("__tm_v").desc_nulls_last() if descending else F.col("__tm_v").asc_nulls_last()
    keys = [F.col(g).asc_nulls_first() for g in groups]
    counts = (df.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(group_cols, groups, strict=True)],
                        F.col(f"`{order_col}`").alias("__tm_v"))
              .groupBy(*groups, "__tm_v").agg(F.count(F.lit(1)).alias("__tm_n")))
    # a range partitioner samples, so two evaluations may cut differently: the partition number is stored
    folder = fresh_dir(spark, "ranks")
    (counts.repartitionByRange(n, *keys, o).withColumn("__tm_p", F.spark_partition_id())
     .write.parquet(folder))
    parted = spark.read.parquet(folder)
    here = Window.partitionBy(*groups, "__tm_p").orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    local = parted.withColumn("__tm_r", F.coalesce(F.sum("__tm_n").over(here), F.lit(0)))
    earlier = Window.partitionBy(*groups).orderBy("__tm_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parted.groupBy(*groups, "__tm_p").agg(F.sum("__tm_n").alias("__tm_n"))
             .select(*[F.col(g).alias(f"{g}p") for g in groups], F.col("__tm_p").alias("__tm_pp"),
                     F.coalesce(F.sum("__tm_n").over(earlier), F.lit(0)).alias("__tm_off")))
    ranked = local.join(parts, [F.col("__tm_p") == F.col("__tm_pp"),
                                *[F.col(g).eqNullSafe(F.col(f"{g}p")) for g in groups]]).select(
        *groups, "__tm_v", (F.col("__tm_r") + F.col("__tm_off") + 1).cast("bigint").alias("__tm_rank"))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(g)) for c, g in zip(group_cols, groups, strict=True)]
    return (df.join(ranked, [*on, F.col(f"`{order_col}`").eqNullSafe(F.col("__tm_v"))])
            .select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], F.col("__tm_rank").alias(out_col)))


def grouped_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, quantiles: Sequence[float],
                      num_partitions: int | None = None) -> DataFrame:
    """Exact discrete quantiles of large groups: (group_cols, ``n``, ``q0``, ``q1``, ...), no group in one task.

    A group's quantile q is its smallest value that at least a share q of its non-null
    values do not exceed (q = 0.5: the lower median; q = 0: the minimum). Rows are counted
    per distinct (group, value), which combines before the shuffle; the distinct values are
    range-partitioned, each partition's running counts start where the group's earlier
    partitions end, and the value whose count first reaches the rank is taken. NaN sorts
    above all numbers; a null group is a group of its own; a group without a value has
    ``n`` 0 and null quantiles.
    """
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = [f"__tm_g{i}" for i in range(len(group_cols))]
    counts = (df.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(group_cols, groups, strict=True)], F.col(f"`{value_col}`").alias("__tm_v"))
              .groupBy(*groups, "__tm_v").agg(F.count("__tm_v").alias("__tm_n")))
    folder = fresh_dir(spark, "quantiles")
    order = [F.col(c).asc_nulls_first() for c in [*groups, "__tm_v"]]
    counts.repartitionByRange(parts, *order).withColumn("__tm_p", F.spark_partition_id()).write.parquet(folder)
    parted = spark.read.parquet(folder)
    earlier = Window.partitionBy(*groups).orderBy("__tm_p").rowsBetween(Window.unboundedPreceding, -1)
    per_part = parted.groupBy(*groups, "__tm_p").agg(F.sum("__tm_n").alias("__tm_k"))
    total = F.sum("__tm_k").over(Window.partitionBy(*groups))
    starts = per_part.select(*[F.col(g).alias(f"{g}p") for g in groups], F.col("__tm_p").alias("__tm_pp"),
                             F.coalesce(F.sum("__tm_k").over(earlier), F.lit(0)).alias("__tm_off"), total.alias("__tm_all"))
    upto = Window.partitionBy(*groups, "__tm_p").orderBy("__tm_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (parted.withColumn("__tm_r", F.sum("__tm_n").over(upto))
              .join(starts, [F.col("__tm_p") == F.col("__tm_pp"), *[F.col(g).eqNullSafe(F.col(f"{g}p")) for g in groups]])
              .withColumn("__tm_r", F.col("__tm_r") + F.col("__tm_off")))
    picked = []
    for i, q in enumerate(quantiles):
        rank = F.greatest(F.ceil(F.col("__tm_all") * F.lit(float(q))), F.lit(1))
        reached = (F.col("__tm_n") > 0) & (F.col("__tm_r") >= rank)
        picked.append(F.min(F.when(reached, F.col("__tm_v"))).alias(f"q{i}"))
    out = ranked.groupBy(*groups).agg(F.max("__tm_all").alias("n"), *picked)
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, group_cols, strict=True)], "n", *[f"q{i}" for i in range(len(quantiles))])
