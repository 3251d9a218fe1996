"""Sketch columns: merging, levels, error bounds, groups without values."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import sketches


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.gammavariate(2, 100), rng.randrange(3000)) for _ in range(60_000)]
    # a third of all rows in one group, NULL and NaN values, a group without values
    rows += [("hot", "x", float(i), i) for i in range(30_000)] + [("a", "x", None, None), ("a", "x", float("nan"), 1), ("none", "y", None, None)]
    return spark.createDataFrame(rows, "g string, h string, v double, who int").repartition(8).cache()


def test_merged_quantiles_stay_within_the_rank_error(facts):
    parts = sketches.sketches(facts.withColumn("part", F.pmod(F.hash("v"), F.lit(12))), ["part", "g", "h"], {"v": "v"}, {"who": "who"})
    merged = sketches.merge(parts, ["g", "h"], "cube")
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = sketches.checked_levels(facts, merged, ["g", "h"], [["g", "h"], ["g"], ["h"], []], "v", "v", probs, 2 * sketches.rank_error()).collect()
    assert len(got) > 10
    assert all(r[f"{p}_within"] for r in got for p in probs)
    total = next(r for r in got if r["level"] == 3)
    assert total["n"] == 90_000


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(1, 101)], "g string, v double")
    one = sketches.sketches(df, ["g"], {"v": "v"}).select(*[sketches.quantile("v", p).alias(f"p{i}") for i, p in enumerate((0, 0.25, 0.5, 1))]).first()
    assert tuple(one) == (1.0, 25.0, 50.0, 100.0)


def test_groups_without_values(facts):
    row = sketches.sketches(facts, ["g"], {"v": "v"}, {"who": "who"}).where("g = 'none'").select("row_count", "v_n", sketches.quantile("v", 0.5).alias("q"), sketches.rank("v", F.lit(1.0)).alias("r"), sketches.distinct("who").alias("d")).first()
    assert tuple(row) == (1, 0, None, None, 0)


def test_distinct_counts_merge_without_counting_twice(facts):
    parts = sketches.merge(sketches.sketches(facts, ["g", "h"], {}, {"who": "who"}), [], "group")
    got = parts.select("row_count", sketches.distinct("who").alias("d")).first()
    exact = facts.agg(F.count_distinct("who")).first()[0]
    assert got["row_count"] == facts.count()
    assert abs(got["d"] - exact) <= 5 * sketches.distinct_error() * exact


def test_a_total_is_told_from_a_null_key(facts):
    merged = sketches.merge(sketches.sketches(facts, ["h"], {"v": "v"}), ["h"], "rollup")
    got = {(r["h"], r["level"]): r["row_count"] for r in merged.collect()}
    assert got[(None, 1)] == facts.count()
    assert got[(None, 0)] == facts.where("h is null").count()


def test_error_falls_with_k_and_sketches_stay_small(facts):
    assert sketches.rank_error(800) < sketches.rank_error(200) < 0.014
    size = sketches.sketches(facts, [], {"v": "v"}, {"who": "who"}).select(F.length("v_kll") + F.length("who_hll")).first()[0]
    assert size < 40_000


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5.0, "a"), (3, 7.0, None)], "`a.b` int, v double, s string")
    got = {r["column_name"]: r for r in sketches.profile_sketches(df).collect()}
    assert (got["a.b"]["lowest"], got["a.b"]["median"], got["a.b"]["highest"], got["a.b"]["distinct_values"]) == (1.0, 2.0, 3.0, 3)
    assert (got["v"]["nulls"], got["s"]["nulls"], got["s"]["distinct_values"], got["s"]["median"]) == (1, 1, 1, None)
    empty = sketches.profile_sketches(df.limit(0)).collect()
    assert [r["row_count"] for r in empty] == [0, 0, 0]


def test_fences_from_sketches(facts):
    got = sketches.fences(sketches.sketches(facts.where("g <> 'none'"), [], {"v": "v"}), "v").first()
    clean = facts.where("v is not null and not isnan(v)")
    exact = clean.where((F.col("v") < got["lower_fence"]) | (F.col("v") > got["upper_fence"])).count() / clean.count()
    assert abs(got["beyond_share"] - exact) < 4 * sketches.rank_error() + 0.002


def test_exact_distinct_counts_of_a_cube(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([None, *range(40)])) for _ in range(2000)] + [("empty", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v int")
    out = sketches.distinct_cube(df, ["g", "h"], "v", "n")
    want = df.cube("g", "h").agg(F.grouping_id().alias("level"), F.count_distinct("v").alias("n")).where("n > 0")
    assert out.columns == ["g", "h", "level", "n"]
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
