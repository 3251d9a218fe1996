"""Fitted tree models as tables of nodes, and scoring from these tables alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path


def nodes(model, path: str | None = None) -> DataFrame:
    """One row per node of a fitted forest or boosted model.

    tree, node (0 is the root), feature (index, -1 in a leaf), threshold (goes left up to it) or categories (go
    left), left, right (-1 in a leaf), prediction, stats (class weights of a classifier), weight of the tree.
    There are at most trees * 2 ** (depth + 1) rows, whatever the data.
    """
    spark = SparkSession.active()
    path = path or scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    n = F.col("nodeData")
    listed = n["split"]["leftCategoriesOrThreshold"]
    nominal = n["split"]["numCategories"] >= 0
    stored = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"), F.when(~nominal, F.get(listed, F.lit(0))).alias("threshold"), F.when(nominal, listed).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"),
    )
    return stored.join(weights, "tree")


def forest(table: DataFrame) -> Column:
    """A node table as one value: an array of trees, each with its weight and its nodes in order. Its size is bounded by the model's."""
    cell = F.struct("node", "feature", "threshold", "categories", "left", "right", "prediction", "stats")
    per_tree = table.groupBy("tree").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("node", cell.alias("n")))).alias("cells"))
    per_tree = per_tree.select("tree", F.struct("tree", "weight", F.transform("cells", lambda c: c["n"]).alias("nodes")).alias("t"))
    return per_tree.agg(F.sort_array(F.collect_list("t")).alias("trees")).scalar()


def _leaf(features: Column, tree: Column, depth: int) -> Column:
    """The leaf a row ends in: from the root, at most ``depth`` steps."""

    def step(at: Column, _: Column) -> Column:
        n = F.get(tree["nodes"], at)
        value = F.get(features, n["feature"])
        goes_left = F.when(n["categories"].isNotNull(), F.array_contains(n["categories"], value)).otherwise(value <= n["threshold"])
        return F.when(n["left"] < 0, at).when(goes_left, n["left"]).otherwise(n["right"])

    return F.get(tree["nodes"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))


def boosted_score(features: Column, trees: Column, depth: int) -> Column:
    """Prediction of a boosted regression: the weighted sum of the leaves."""
    return F.aggregate(trees, F.lit(0.0), lambda total, t: total + t["weight"] * _leaf(features, t, depth)["prediction"])


def class_shares(features: Column, trees: Column, depth: int, classes: int) -> Column:
    """Class probabilities of a forest: the mean of the class shares of the leaves."""

    def add(total: Column, t: Column) -> Column:
        stats = _leaf(features, t, depth)["stats"]
        whole = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(total, stats, lambda a, b: a + b / whole)

    votes = F.aggregate(trees, F.array(*[F.lit(0.0)] * classes), add)
    return F.transform(votes, lambda v: v / F.aggregate(votes, F.lit(0.0), lambda a, b: a + b))
