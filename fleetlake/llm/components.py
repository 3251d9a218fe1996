"""Connected components of links between numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return tied.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the component's smallest node.

    The rounds go on until the links no longer change; each is written to the shared folder, so a lost
    executor costs one round at most. Least values are aggregated before they are joined to a hub's links.
    """
    now = materialise(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
        now = materialise(_small_star(_large_star(now)), "links")
