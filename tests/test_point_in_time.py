"""Point-in-time and as-of joins by carrying versions forward, also over hot keys, against range joins."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import joins
from fleetlake.warehouse import dims


@pytest.fixture(scope="module")
def tables(spark):
    """Versions without overlap but with gaps; one key holds most facts, one day of it very many."""
    rng = random.Random(3)
    versions, facts = [], []
    for key in ["hot", "a", "b", "c"]:
        day = date(2024, 1, 1)
        for n in range(400 if key == "hot" else 6):
            end = day + timedelta(days=rng.randrange(3))
            versions.append((key, f"{key}{n}", n, day, end))
            day = end + timedelta(days=rng.choice([1, 1, 1, 4]))
    for i in range(6000):
        key = "hot" if i % 3 else rng.choice(["a", "b", "c", "unknown", None])
        at = datetime(2024, 2, 1, 12) if rng.random() < 0.2 else datetime(2023, 12, 20) + timedelta(hours=rng.randrange(24 * 900))
        facts.append((i, key, None if i % 501 == 0 else at))
    return (
        spark.createDataFrame(facts, "id int, k string, at timestamp").repartition(6).cache(),
        spark.createDataFrame(versions, "k string, name string, n int, valid_from date, valid_to date").cache(),
    )


def by_range(facts, dim, how):
    v = dim.withColumnRenamed("k", "_k")
    return facts.join(v, (F.col("k") == F.col("_k")) & F.to_date("at").between(F.col("valid_from"), F.col("valid_to")), how).drop("_k")


def content(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("hot", [None, "150"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_range_join(spark, tables, how, hot):
    facts, dim = tables
    if hot:
        spark.conf.set("fleetlake.hotGroupRows", hot)
    try:
        got = joins.point_in_time(facts, dim, "k", "at", how)
        want = by_range(facts, dim, how)
        assert got.columns == want.columns
        assert content(got) == content(want)
    finally:
        spark.conf.unset("fleetlake.hotGroupRows")


@pytest.mark.parametrize("hot", [None, "150"])
def test_asof_over_a_hot_key(spark, tables, hot):
    facts, dim = tables
    if hot:
        spark.conf.set("fleetlake.hotGroupRows", hot)
    try:
        got = joins.asof_join(facts, dim, ["k"], "at", "valid_from", "name")
        last = facts.join(dim.withColumnRenamed("k", "_k"), (F.col("k") == F.col("_k")) & (F.col("valid_from") <= F.to_date("at")), "left")
        want = last.groupBy("id", "k", "at").agg(F.max_by("name", "valid_from").alias("name"))
        assert content(got) == content(want)
    finally:
        spark.conf.unset("fleetlake.hotGroupRows")


def test_no_range_test_in_the_join(spark, tables):
    facts, dim = tables
    plan = joins.point_in_time(facts, dim, "k", "at")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("hashpartitioning(k") == 1


def test_overlapping_versions_are_found(spark, tables):
    dim = tables[1]
    assert joins.overlapping_versions(dim, "k").count() == 0
    bad = dim.unionByName(spark.createDataFrame([("a", "late", 9, date(2024, 1, 2), date(2024, 1, 9))], dim.schema))
    assert {r["k"] for r in joins.overlapping_versions(bad, "k").collect()} == {"a"}


def test_surrogate_key_of_the_version(spark):
    dim = spark.createDataFrame([(1, 10, date(2024, 1, 1), date(2024, 1, 31)), (1, 11, date(2024, 2, 1), date(9999, 12, 31)), (-1, -1, date(1900, 1, 1), date(9999, 12, 31))], "id int, sk long, valid_from date, valid_to date")
    facts = spark.createDataFrame([(1, 1, date(2024, 1, 31)), (2, 1, date(2024, 2, 1)), (3, 1, date(2023, 1, 1)), (4, 7, date(2024, 1, 1)), (5, None, None)], "f int, id int, d date")
    got = {r.f: r.sk for r in dims.lookup_at(facts, dim, "id", "sk", "d").collect()}
    assert got == {1: 10, 2: 11, 3: -1, 4: -1, 5: -1}


def test_only_the_days_of_the_facts_are_ordered(spark, monkeypatch):
    ordered, carried = [], joins._carried
    monkeypatch.setattr(joins, "_carried", lambda facts, *a: ordered.append(facts) or carried(facts, *a))
    facts = spark.range(5000).selectExpr("id", "IF(id % 100 = 7, NULL, id % 2) AS k", "date_add(DATE'2024-01-01', int(id % 10)) AS at")
    line = spark.createDataFrame([(0, "2024-01-03", 3.0), (0, "2024-01-08", 8.0), (None, "2024-01-01", 1.0)], "k long, since string, v double")
    for most in (0, joins.BROADCAST_DAYS):
        monkeypatch.setattr(joins, "BROADCAST_DAYS", most)
        out = joins.asof_join(facts, line, ["k"], "at", "since", "v")
        assert out.columns == ["id", "k", "at", "v"]
        got = {r.id: r.v for r in out.collect()}
        assert got == {i: None if i % 100 == 7 or i % 2 or i % 10 < 2 else 3.0 if i % 10 < 7 else 8.0 for i in range(5000)}
    assert ordered[0].columns == ["k", "_day"] and ordered[0].count() == 10
