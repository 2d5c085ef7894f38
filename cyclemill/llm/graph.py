"""Connected components of a graph given as edges, in Spark joins and sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import written


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the large-star / small-star scheme on edges (a, b) with a > b.

    Large: every larger neighbour is linked to the node's least neighbour (or itself).
    Small: every smaller neighbour, and the node, are linked to the least of them.
    """
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(flipped) if large else edges
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    joined = near.join(least, "a")
    if large:
        made = joined.filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        made = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return made.filter("a != b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); the root is the least node of its component.

    Each round is written to the shared folder. It ends when a round changes nothing,
    which takes about the logarithm of the longest path. No node without an edge is returned.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = written(edges.filter("a != b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        edges = written(star(written(star(edges, True), "edges"), False), "edges")
        # a fixed point has the same sums again: every node points at its root
        now = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)),
        ).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
