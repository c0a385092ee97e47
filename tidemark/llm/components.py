"""Connected components of an edge table, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node of its component.

    Each round points every larger neighbour of a node at the node's smallest neighbour
    (large star), then every node's smaller neighbours and the node itself at the
    smallest of them (small star). Both take a minimum per node, which combines before
    the shuffle, and a join back that adaptive execution can split, so a node with many
    edges is no hot task. Rounds are stored in the shared folder; the number of rounds
    grows with the logarithm of the longest path. Null and self edges are ignored.
    """
    cur = store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .filter("u is not null and v is not null and u != v").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        cur = store(small, "edges")
        row = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
                      F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()
        if row == mark:
            break
        mark = row
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # settled: every node points at its root, and the roots are the targets
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
