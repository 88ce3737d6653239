"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import cut


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """One row ``(node, component)`` for each node with an edge to another; component: its smallest node.

    Minima are combined before the shuffle, joins are plain equi-joins that adaptive execution may
    split at hot nodes, and every round ends in a checkpoint. Null ends and loops are ignored. The
    number of rounds grows with the logarithm of the longest path.
    """
    pairs = _ordered(edges.select(F.col(u).alias("a"), F.col(v).alias("b")))
    pairs = cut(pairs)
    seen = _digest(pairs)
    while seen[0]:
        pairs = cut(_small_star(_large_star(pairs)))
        now = _digest(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    own = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return roots.unionByName(own)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the larger end first."""
    return (
        pairs.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _digest(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _ordered(both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, moves to its smallest neighbour."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))
