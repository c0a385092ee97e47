"""Matching two sources whose dates differ by a few days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import assert_unique


def _days(c: Column) -> Column:
    return F.unix_date(F.to_date(c))


def nearest_match(a: DataFrame, b: DataFrame, keys: Sequence[str], date: str, value: str, days: int,
                  tolerance: float) -> DataFrame:
    """Each row of ``a`` with the row of ``b`` nearest in time, at most ``days`` days away.

    Dates are cut into bins of 2 * ``days`` + 1 days; a row of ``b`` lies in the one or two
    bins that its band touches, so the match is an equi-join on (keys, bin) and a key that
    holds a third of all rows spreads over its bins. Of equally near rows the earlier
    counts. Returns keys, ``date_a``, ``value_a``, ``date_b``, ``value_b``, ``status``:
    match (values within ``tolerance``), mismatch, only_a, or only_b for rows of ``b`` that
    are in no band. (keys, date) must be unique on each side; rows with a null key or date
    match nothing; a null value is a mismatch.
    """
    keys = list(keys)
    for side, what in ((a, "first source"), (b, "second source")):
        assert_unique(side.dropna(subset=[*keys, date]), [*keys, date], what)
    width = 2 * days + 1
    names = [f"__k{i}" for i in range(len(keys))]
    own = [F.col(f"`{k}`") for k in keys]
    left = a.select(*own, F.col(date).alias("date_a"), F.col(value).alias("value_a"))
    right = b.select(*[c.alias(n) for c, n in zip(own, names, strict=True)], F.col(date).alias("date_b"), F.col(value).alias("value_b"))
    day_a, day_b = _days(F.col("date_a")), _days(F.col("date_b"))
    bins = F.array_distinct(F.array(F.floor((day_b - days) / width), F.floor((day_b + days) / width)))
    on = [c == F.col(n) for c, n in zip(own, names, strict=True)]
    pairs = (left.withColumn("__bin_a", F.floor(day_a / width)).join(right.withColumn("__bin", F.explode(bins)), [
        *on, F.col("__bin_a") == F.col("__bin")]).where(F.abs(day_a - day_b) <= days))
    # one row of a key and date: the grouping below keeps it apart from all others
    best = (pairs.groupBy(*names, "date_a").agg(F.min(F.struct(F.abs(day_a - day_b).alias("gap"), "date_b", "value_b")).alias("best"))
            .withColumnRenamed("date_a", "__date_a"))
    found = (left.join(best, [*on, F.col("date_a") == F.col("__date_a")], "left")
             .select(*own, "date_a", "value_a", F.col("best.date_b").alias("date_b"), F.col("best.value_b").alias("value_b"),
                     F.when(F.col("best").isNull(), "only_a")
                     .when(F.abs(F.col("value_a") - F.col("best.value_b")) <= tolerance, "match").otherwise("mismatch").alias("status")))
    met = pairs.select(*[F.col(n).alias(f"{n}m") for n in names], F.col("date_b").alias("__date_m")).distinct()
    alone = right.join(met, [*[F.col(n) == F.col(f"{n}m") for n in names], F.col("date_b") == F.col("__date_m")], "left_anti")
    none = F.lit(None)
    return found.unionByName(alone.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], none.cast(left.schema["date_a"].dataType).alias("date_a"),
        none.cast(left.schema["value_a"].dataType).alias("value_a"), "date_b", "value_b", F.lit("only_b").alias("status")))
