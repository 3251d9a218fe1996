"""Scores from node tables against the fitted models."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from fleetlake.models import trees


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(400).selectExpr("id", "id % 11 as a", "concat('c', id % 6) as c", "double(id % 11 + 3 * (id % 6) + (id * 7919 % 13) / 5) as label", "double(id % 3) as kind")


def prepared(stage, label):
    return Pipeline(stages=[StringIndexer(inputCol="c", outputCol="code"), VectorAssembler(inputCols=["a", "code"], outputCol="features"), stage.setLabelCol(label)])


def test_boosted_trees_with_categories(frame):
    model = prepared(GBTRegressor(maxIter=6, maxDepth=4, stepSize=0.3, seed=1), "label").fit(frame)
    table = trees.nodes(model.stages[2])
    assert table.where("categories is not null").count() > 0 and table.where("threshold is not null").count() > 0
    scored = model.transform(frame).select("prediction", vector_to_array("features").alias("f")).withColumn("t", trees.forest(table))
    off = scored.select(F.max(F.abs(F.col("prediction") - trees.boosted_score(F.col("f"), F.col("t"), 4)))).first()[0]
    assert off < 1e-9


def test_forest_probabilities(frame):
    model = prepared(RandomForestClassifier(numTrees=7, maxDepth=3, seed=1), "kind").fit(frame)
    scored = model.transform(frame).select(vector_to_array("probability").alias("p"), vector_to_array("features").alias("f")).withColumn("t", trees.forest(trees.nodes(model.stages[2])))
    own = trees.class_shares(F.col("f"), F.col("t"), 3, 3)
    for r in scored.select("p", own.alias("own")).distinct().collect():
        assert r["own"] == pytest.approx(r["p"], abs=1e-9)


def test_a_node_table_is_a_set_of_trees(frame):
    model = prepared(GBTRegressor(maxIter=3, maxDepth=3, stepSize=0.5, seed=1), "label").fit(frame)
    rows = trees.nodes(model.stages[2]).collect()
    assert {r.tree: r.weight for r in rows} == dict(enumerate(model.stages[2].treeWeights))
    for tree in range(3):
        own = {r.node: r for r in rows if r.tree == tree}
        reached, todo = set(), [0]
        while todo:
            n = todo.pop()
            reached.add(n)
            if own[n].left >= 0:
                todo += [own[n].left, own[n].right]
        assert reached == set(own)
