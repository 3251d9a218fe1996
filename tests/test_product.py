"""Products of two tables in blocks."""

from fleetlake.operators import joins


def test_blocks_cover_every_pair_once(spark):
    left, right = spark.range(37).withColumnRenamed("id", "l").repartition(5), spark.range(53).withColumnRenamed("id", "r").repartition(3)
    for right_block, left_block in ((1000, 100_000), (7, 10), (1, 1), (53, 5)):
        got = [tuple(x) for x in joins.product(left, right, right_block, left_block).collect()]
        assert len(got) == 37 * 53 == len(set(got))


def test_empty_sides(spark):
    some, none = spark.range(3).withColumnRenamed("id", "l"), spark.range(0).withColumnRenamed("id", "r")
    assert joins.product(some, none).count() == 0
    assert joins.product(none, some).count() == 0


def test_repeated_rows_and_nulls_stay(spark):
    left = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    right = spark.createDataFrame([("x", None), ("x", None)], "b string, c int")
    got = joins.product(left, right, 1, 1)
    assert got.columns == ["a", "b", "c"] and got.count() == 6


def test_a_large_product_holds_no_side_in_one_cell(spark):
    left, right = spark.range(100_000).withColumnRenamed("id", "l"), spark.range(100_000).withColumnRenamed("id", "r")
    plan = joins.product(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    gathers = [line for line in plan.splitlines() if "collect_list" in line]
    assert gathers and all("keys=[_b" in line for line in gathers)
    assert joins.product(left.limit(200), right).count() == 200 * 100_000
