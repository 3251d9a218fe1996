"""Reachability in a table of edges, by doubling the length of known paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.session import materialise, scratch_path

#: Paths are doubled while their table stays below this many rows, or this many times the edges.
MOST_PATHS = 2_000_000
PER_EDGE = 32
#: Rounds before doubling begins: a flat graph is done by then and pays for no paths.
PLAIN = 3


def double(paths: DataFrame, span: int) -> DataFrame:
    """Shortest distances (a, b, d) up to ``2 * span`` from all up to ``span``.

    A longer shortest path has a node at exactly ``span``, so only the paths of that length are continued.
    """
    onward = paths.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("d").alias("more"))
    longer = paths.where(F.col("d") == span).join(onward, "b").where("a <> c").select("a", F.col("c").alias("b"), (F.col("d") + F.col("more")).alias("d"))
    return paths.unionByName(longer).groupBy("a", "b").agg(F.min("d").alias("d"))


def doubled_size(paths: DataFrame, span: int) -> int:
    """Rows that ``double`` would join, without joining: paths of length ``span`` into each node times paths out of it."""
    ends = paths.where(F.col("d") == span).groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("into"))
    begins = paths.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("out"))
    return ends.join(begins, "node").agg(F.sum(F.col("into") * F.col("out"))).first()[0] or 0


def ahead(paths: DataFrame, reached: DataFrame, depth: int) -> DataFrame:
    """Paths that can still lead to new nodes: from nodes at ``depth`` or not reached yet, to nodes not reached yet.

    A shortest path to a node beyond ``depth`` leaves the reached ones at exactly ``depth`` and does not come back.
    """
    onward = paths.join(reached.where(F.col("depth") < depth).select(F.col("node").alias("a")), "a", "left_anti")
    return onward.join(reached.select(F.col("node").alias("b")), "b", "left_anti").select("a", "b", "d")


def reach(edges: DataFrame, start: DataFrame, source: str = "source", target: str = "target", most_paths: int = MOST_PATHS, per_edge: int = PER_EDGE) -> tuple[DataFrame, int]:
    """(node, depth) of all nodes reachable from ``start`` (column ``node``), start at depth 0, and the number of rounds.

    A round extends what is reached by all known paths and, after the first few, doubles these, so a chain of n
    edges takes about log2(n) rounds. Only paths that lead on from there are kept (``ahead``). A node beyond the reach so far lies behind one at exactly that
    depth, so only those are extended. Where doubling would make too many paths (their number is known
    before), the rounds go on with the span they have. Cycles and repeated edges are harmless; edges with
    a NULL end lead nowhere. Every round is written to the shared folder.
    """
    spark, root = edges.sparkSession, scratch_path(edges.sparkSession, "reach")
    links = edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a is not null and b is not null and a <> b").distinct()
    paths = materialise(links.withColumn("d", F.lit(1).cast("bigint")), "paths")
    limit = max(most_paths, per_edge * paths.count())
    first = start.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0).cast("bigint"))
    first.write.parquet(f"{root}/round=0")
    schema = first.schema
    reached = frontier = spark.read.schema(schema).parquet(f"{root}/round=0")
    span, depth, rounds, doubling = 1, 0, 0, True
    while True:
        rounds += 1
        step = frontier.join(paths.withColumnRenamed("a", "node"), "node").groupBy(F.col("b").alias("node")).agg(F.min(F.col("depth") + F.col("d")).alias("depth"))
        step.join(reached, "node", "left_anti").write.parquet(f"{root}/round={rounds}")
        found = spark.read.schema(schema).parquet(f"{root}/round={rounds}")
        depth += span
        reached = spark.read.schema(schema).parquet(*[f"{root}/round={i}" for i in range(rounds + 1)])
        frontier = found.where(F.col("depth") == depth)
        if frontier.isEmpty():
            return reached, rounds
        if doubling and rounds >= PLAIN:
            paths = materialise(ahead(paths, reached, depth), "paths")
            doubling = doubled_size(paths, span) <= limit
            if doubling:
                paths = materialise(double(paths, span), "paths")
                span *= 2
