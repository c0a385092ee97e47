"""Rollups kept up to date from the images of a merge instead of a rebuild.

A merge changes a table by its before and after images: a row that is updated leaves with
weight -1 and comes back with weight +1, an inserted row comes with +1. Counts and sums of
any grouping follow by adding the weighted images, so a rollup reads the touched keys and
the touched groups only. Minima and maxima cannot be taken back and are not kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import assert_unique
from tidemark.sinks.upsert import merged

#: +1 for a row that the table has after the merge, -1 for one that it had before
WEIGHT = "__weight"


def change_images(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                  newer_wins: str | Sequence[str] | None = None) -> DataFrame:
    """The rows that a merge of ``source`` into ``target`` takes out (:data:`WEIGHT` -1) and puts in (+1).

    Only rows of ``target`` whose key is in ``source`` are read, by a semi join that prunes
    partitions where keys are partition columns. A source row that changes nothing, or
    that ``newer_wins`` skips, gives no images. A null key matches nothing: such a source
    row is an insert. Duplicate source keys raise.
    """
    keys = list(keys)
    assert_unique(source.dropna(subset=keys), keys, "source")
    if target is None:
        return source.withColumn(WEIGHT, F.lit(1))
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    touched = source.dropna(subset=keys).select(*[F.col(f"`{k}`").alias(n) for k, n in names.items()])
    before = target.join(touched, [F.col(f"`{k}`") == F.col(n) for k, n in names.items()], "left_semi")
    after = merged(before, source, keys, newer_wins)
    cols = after.columns
    types = {f.name: f.dataType for f in after.schema.fields}
    had = before.select(*[(F.col(f"`{c}`") if c in before.columns else F.lit(None).cast(types[c])).alias(c) for c in cols])
    both = had.withColumn(WEIGHT, F.lit(-1)).unionByName(after.withColumn(WEIGHT, F.lit(1)))
    # equal images of a key cancel out
    return (both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum(WEIGHT).cast("int").alias(WEIGHT))
            .where(F.col(WEIGHT) != 0))


def rollup_deltas(images: DataFrame, groups: Mapping[str, Column], sums: Mapping[str, Column]) -> DataFrame:
    """What the images add to each group: the group columns, ``n_rows`` and the named sums.

    Sums are exact for decimal and whole-number measures. A null measure adds nothing.
    """
    w = F.col(WEIGHT)
    return (images.select(*[c.alias(n) for n, c in groups.items()], w, *[c.alias(f"__m_{n}") for n, c in sums.items()])
            .groupBy(*groups).agg(F.sum(w).cast("long").alias("n_rows"),
                                  *[F.sum(F.col(f"__m_{n}") * w).alias(n) for n in sums]))


def apply_deltas(rollup: DataFrame | None, deltas: DataFrame, groups: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The new rows of the groups that ``deltas`` touches; a group without rows any more has ``n_rows`` 0.

    Only these groups of ``rollup`` are read. Group columns may be null.
    """
    zero = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(deltas.schema[c].dataType)).alias(c) for c in ("n_rows", *sums)}
    new = deltas.select(*groups, *zero.values())
    if rollup is None:
        return new
    old = rollup.select(*[F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(groups)],
                        *[F.col(f"`{c}`").alias(f"__old_{c}") for c in ("n_rows", *sums)])
    both = new.join(old, [F.col(f"`{g}`").eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)], "left")
    # a sum keeps its type from increment to increment
    kinds = {c: rollup.schema[c].dataType for c in ("n_rows", *sums)}
    return both.select(*groups, *[(F.col(c) + F.coalesce(F.col(f"__old_{c}"), F.lit(0).cast(kinds[c]))).cast(kinds[c]).alias(c)
                                  for c in ("n_rows", *sums)])
