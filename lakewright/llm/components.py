"""Connected components of an edge table by iterative joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """node, root for every node of edges(a, b): root is the smallest node that a path reaches.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round sends each node's
    larger neighbours, then its smaller ones, to its smallest neighbour. Both are one groupBy-min and one
    join on the node; the edge count never grows, so a hub costs no more than its edges. Each round is
    checkpointed, and the loop ends when a round changes nothing. No edges: no rows.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _digest(edges)
    for _ in range(max_rounds):
        edges = checkpointed(_small_star(_large_star(edges)))
        now = _digest(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
    larger = edges.select(F.col("a").alias("big"), F.col("b").alias("n"))
    return larger.join(least, "n").select(F.col("big").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges["a"] == least["n"]).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b")
    return moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return tuple(row)
