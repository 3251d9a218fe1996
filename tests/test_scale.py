"""Split path of the ordered operators: one group holds a third of the rows and more, with ties and NULLs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.operators import scale, windows
from fleetlake.operators.aggregates import boxplot


@pytest.fixture(scope="module")
def frame(spark):
    """4,000 rows: key 'hot' holds more than half, one day of it very many, plus a NULL key and NULL values."""
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        key = "hot" if i % 5 < 3 else rng.choice(["a", "b", "c", None])
        day = date(2024, 1, 1) if rng.random() < 0.4 else date(2024, 1, 1) + timedelta(days=rng.randrange(60))
        rows.append((key, None if i % 997 == 0 else day, i, float(rng.randrange(50)), rng.randrange(1000) / 100))
    df = spark.createDataFrame(rows, "k string, d date, id bigint, v double, amount double")
    return df.repartition(5).cache()


def same(a, b, cols):
    x = sorted(map(str, a.select(*cols).collect()))
    y = sorted(map(str, b.select(*cols).collect()))
    assert x == y


ORDERS = [["d", "id"], ["-d", "id"], ["d", "-id"], ["-d", "-id"], ["v", "id"], ["id"], ["v", "d", "id"]]


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", ORDERS)
def test_running_equals_window(frame, keys, order):
    sums = {"s": F.col("amount").cast("decimal(18,4)"), "n": F.lit(1).cast("bigint")}
    split = scale.Split(frame, keys, order, 100)
    assert not split.small
    got = scale.running(frame, keys, order, sums, split=split)
    w = Window.partitionBy(*keys).orderBy(*scale.order_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    want = frame.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    same(got, want, ["id", "s", "n"])


@pytest.mark.parametrize("keys", [["k"], []])
def test_bounded_equals_window(frame, keys):
    exprs = {
        "prev": lambda w: F.lag("id").over(w),
        "next2": lambda w: F.lead("id", 2).over(w),
        "mean5": lambda w: F.avg("v").over(w.rowsBetween(-4, 0)),
        "top": lambda w: F.max("v").over(w.rowsBetween(-6, 2)),
    }
    got = scale.bounded(frame, keys, ["d", "id"], exprs, before=6, after=2, hot_rows=50)
    w = Window.partitionBy(*keys).orderBy(*scale.order_columns(["d", "id"]))
    want = frame.withColumns({n: f(w) for n, f in exprs.items()})
    same(got, want, ["id", *exprs])


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v", "id"], ["-amount", "id"]])
def test_ntile_equals_window(frame, keys, order):
    got = scale.ntile(frame, keys, order, {"q": 4, "d10": 10}, hot_rows=100)
    w = Window.partitionBy(*keys).orderBy(*scale.order_columns(order))
    want = frame.withColumns({"q": F.ntile(4).over(w), "d10": F.ntile(10).over(w)})
    same(got, want, ["id", "q", "d10"])


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("value", ["v", "-amount", "d"])
def test_ranks_equal_window(frame, keys, value):
    got = scale.ranks(frame, keys, value, rank="r", dense="dr", percent="p", cume="c", hot_rows=100)
    w = Window.partitionBy(*keys).orderBy(*scale.order_columns([value]))
    want = frame.withColumns({"r": F.rank().over(w), "dr": F.dense_rank().over(w), "p": F.percent_rank().over(w), "c": F.cume_dist().over(w)})
    same(got, want, ["id", "r", "dr", "p", "c"])


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_are_exact(frame, keys):
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = scale.percentiles(frame, keys, "amount", probs, hot_rows=30)
    want = frame.groupBy(*keys).agg(*[F.percentile("amount", F.lit(p)).alias(n) for n, p in probs.items()])
    rounded = [F.round(n, 9).alias(n) for n in probs]
    same(got.select(*keys, *rounded), want.select(*keys, *rounded), [*keys, *probs])


def test_sessions_do_not_depend_on_the_split(spark, frame):
    stamped = frame.where("d IS NOT NULL").withColumn("ts", F.col("d").cast("timestamp"))
    plain = windows.sessionize(stamped, ["k"], "ts", "id", gap_days=1)
    spark.conf.set("fleetlake.hotGroupRows", "60")
    try:
        split = windows.sessionize(stamped, ["k"], "ts", "id", gap_days=1)
        same(split, plain, ["id", "session_id"])
    finally:
        spark.conf.unset("fleetlake.hotGroupRows")


def test_empty_and_single_row(spark, frame):
    empty = frame.limit(0)
    assert scale.row_number(empty, ["k"], ["d", "id"]).count() == 0
    assert scale.percentiles(empty, ["k"], "amount", {"p": 0.5}).count() == 0
    one = frame.where("id = 5")
    assert scale.ranks(one, [], "v", rank="r", percent="p").select("r", "p").first() == (1, 0.0)


def test_small_groups_use_one_window(frame):
    plan = scale.row_number(frame, ["k"], ["d", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_boxplot_without_keys(frame):
    row = boxplot(frame, [], "amount").first()
    assert row["row_count"] == 4000 and row["q1"] <= row["median"] <= row["q3"]


TEXT_ORDERS = [["ident"], ["-ident"], ["flag", "ident"], ["price", "ident"], ["-flag", "-ident"]]


@pytest.mark.parametrize("order", TEXT_ORDERS)
def test_text_boolean_and_decimal_orders(frame, order):
    df = frame.select(
        "k", F.format_string("TR%06d", "id").alias("ident"), (F.col("id") % 3 == 0).alias("flag"), F.col("amount").cast("decimal(18,4)").alias("price")
    ).cache()
    got = scale.running(df, ["k"], order, {"n": F.lit(1).cast("bigint"), "s": F.col("price")}, hot_rows=90)
    w = Window.partitionBy("k").orderBy(*scale.order_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    same(got, df.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum("price").over(w)}), ["ident", "n", "s"])


def test_very_many_hot_groups_and_ranges(spark):
    """1,100 groups above the limit, cut into more than 2,000 ranges."""
    df = spark.range(6600).select((F.col("id") % 1100).alias("g"), F.format_string("TR%06d", "id").alias("ident"))
    split = scale.Split(df, ["g"], ["ident"], 5)
    assert not split.small
    marked = split.mark(df)
    assert marked.select("_r").distinct().count() > 2000
    got = scale.row_number(df, ["g"], ["ident"], split=split)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("ident")))
    same(got, want, ["g", "ident", "rn"])


def test_the_limit_does_not_grow_with_the_data(spark):
    df = spark.range(5000).select(F.lit("one").alias("g"), "id")
    assert not scale.Split(df, ["g"], ["id"], 4999).small
    assert scale.Split(df, ["g"], ["id"], 5000).small
    assert not scale.Split(df, ["g"], ["id"], force=True).small
