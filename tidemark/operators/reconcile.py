"""Content reconciliation: which keys differ between two tables that should hold the same rows.

Rows are hashed on the executors and their hashes summed per bucket of the key's hash. Sums
do not depend on order, so one partial aggregate gives a tree of them: leaves, their parents
and the root. Two trees are compared from the root down; only children of a parent that
differs are looked at, and only rows of leaves that differ are read again, down to keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.operators.quality import CHECK_COLUMNS

#: children of a node, and levels below the root; 256 ** 2 leaves bound what a comparison joins
FAN, LEVELS = 256, 2
_SUMS = ["n", "h1", "h2"]


def _plain(df: DataFrame, c: str) -> Column:
    """A column as it is hashed and compared: 0.0 and -0.0 are one value."""
    col = F.col(f"`{c}`")
    return col + F.lit(0.0).cast(df.schema[c].dataType) if isinstance(df.schema[c].dataType, (DoubleType, FloatType)) else col


def hashed_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys`` and ``columns`` (as given) with ``__leaf`` and two hashes of each row.

    A null takes part as itself: its position is hashed along, so a value that moves from
    one column to a null neighbour changes the hash.
    """
    def parts(names, seed):
        out = [F.lit(seed)]
        for c in names:
            out += [F.col(f"`{c}`").isNull(), _plain(df, c)]
        return F.xxhash64(*out)
    both = [*keys, *[c for c in columns if c not in keys]]
    return df.select(*[F.col(f"`{c}`") for c in both], F.pmod(parts(keys, 0), F.lit(FAN ** LEVELS)).cast("int").alias("__leaf"),
                     parts(both, 1).alias("__h1"), parts(both, 2).alias("__h2"))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("__h1").cast("decimal(38,0)")).alias("h1"),
            F.sum(F.col("__h2").cast("decimal(38,0)")).alias("h2")]


def content_tree(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(level, node, n, h1, h2): order-free sums of the row hashes, the leaves' and all their parents'.

    At most FAN ** LEVELS leaves leave the first aggregate, whatever the table's size, and
    one key that holds a third of the rows combines before the shuffle. The tree can be
    stored with a table and compared later without reading the table again.
    """
    leaves = hashed_rows(df, keys, columns).groupBy("__leaf").agg(*_sums())
    # a leaf counts towards itself and every parent
    nodes = F.array(*[F.struct(F.lit(level).alias("level"),
                               F.floor(F.col("__leaf") / FAN ** (LEVELS - level)).cast("int").alias("node"))
                      for level in range(LEVELS + 1)])
    return (leaves.select(F.explode(nodes).alias("at"), *_SUMS).groupBy("at.level", "at.node")
            .agg(*[F.sum(c).alias(c) for c in _SUMS]))


def differing_leaves(source_tree: DataFrame, target_tree: DataFrame) -> DataFrame:
    """(leaf): the leaves whose sums differ, found from the root down."""
    def side(tree, tag):
        return tree.select("level", "node", F.struct(*_SUMS).alias(tag))
    both = (side(source_tree, "s").join(side(target_tree, "t"), ["level", "node"], "full_outer")
            .where(~F.col("s").eqNullSafe(F.col("t"))).select("level", "node"))
    open_nodes = both.where("level = 0").select("node")
    for level in range(1, LEVELS + 1):
        parent = open_nodes.select(F.col("node").alias("__parent"))
        here = both.where(F.col("level") == level).select("node", F.floor(F.col("node") / FAN).cast("int").alias("__parent"))
        open_nodes = here.join(parent, "__parent", "left_semi").select("node")
    return open_nodes.select(F.col("node").alias("__leaf"))


def content_diff(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 leaves: DataFrame | None = None) -> DataFrame:
    """The keys whose rows differ: keys, ``status``, ``n_source``, ``n_target``, ``changed_columns``.

    ``status`` is ``missing`` (only in the source), ``extra`` (only in the target) or
    ``changed``; ``changed_columns`` names the columns that differ, comma-separated in the
    order of ``columns``, where both sides hold one row of the key (else null). Rows are
    compared as multisets, so a key that is there twice against once is changed. Nulls are
    values here: a null key is one key, and null equals null. ``leaves`` are those that
    differ, if they are known from stored trees.
    """
    keys = list(keys)
    values = [c for c in columns if c not in keys]
    if leaves is None:
        leaves = differing_leaves(content_tree(source, keys, columns), content_tree(target, keys, columns))

    def side(df: DataFrame, tag: str) -> DataFrame:
        rows = hashed_rows(df, keys, columns).join(F.broadcast(leaves), "__leaf", "left_semi")  # at most FAN ** LEVELS numbers
        one = F.min(F.struct(F.col("__h1"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values)])).alias("row")
        return (rows.groupBy(*[F.col(f"`{k}`").alias(f"__{tag}{i}") for i, k in enumerate(keys)])
                .agg(*_sums(), one).select(*[f"__{tag}{i}" for i in range(len(keys))], F.struct(*_SUMS, "row").alias(tag)))
    on = [F.col(f"__s{i}").eqNullSafe(F.col(f"__t{i}")) for i in range(len(keys))]
    both = side(source, "s").join(side(target, "t"), on, "full_outer")
    same = F.struct(*[F.col(f"s.{c}") for c in _SUMS]).eqNullSafe(F.struct(*[F.col(f"t.{c}") for c in _SUMS]))
    status = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("changed")
    names = F.concat_ws(",", *[F.when(~F.col(f"s.row.v{i}").eqNullSafe(F.col(f"t.row.v{i}")), F.lit(c)) for i, c in enumerate(values)])
    single = (status == "changed") & (F.col("s.n") == 1) & (F.col("t.n") == 1)
    return (both.where(F.col("s").isNull() | F.col("t").isNull() | ~same)
            .select(*[F.when(F.col("s").isNull(), F.col(f"__t{i}")).otherwise(F.col(f"__s{i}")).alias(k) for i, k in enumerate(keys)],
                    status.alias("status"), F.coalesce("s.n", F.lit(0)).alias("n_source"), F.coalesce("t.n", F.lit(0)).alias("n_target"),
                    F.when(single, names).alias("changed_columns")))


def compare_content(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    name: str = "content") -> DataFrame:
    """One result row like those of the other checks; passes when both sides hold the same rows.

    ``difference`` is the number of leaves that differ, zero when it passes.
    """
    sides = [content_tree(df, keys, columns).select("level", "node", F.lit(is_source).alias("src"), F.struct(*_SUMS).alias("sums"))
             for df, is_source in ((source, True), (target, False))]
    s, t = (F.max(F.when(F.col("src") == is_source, F.col("sums"))) for is_source in (True, False))
    nodes = sides[0].unionByName(sides[1]).groupBy("level", "node").agg(s.alias("s"), t.alias("t"))
    root, leaf = F.col("level") == 0, F.col("level") == LEVELS
    row = nodes.agg(*[F.coalesce(F.max(F.when(root, F.col(f"{side}.n"))), F.lit(0)).alias(f"{name}_count")
                      for side, name in (("s", "source"), ("t", "target"))],
                    F.count_if(leaf & ~F.col("s").eqNullSafe(F.col("t"))).alias("difference"))
    return row.select(F.lit(name).alias("check_name"), F.lit("content").alias("check_kind"), (F.col("difference") == 0).alias("passed"),
                      "source_count", "target_count", "difference",
                      *[F.lit(None).cast("string").alias(c) for c in ("source_min", "source_max", "target_min", "target_max")],
                      (F.col("target_count") == 0).alias("target_empty")).select(*CHECK_COLUMNS)
