from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fleetlake.functions import scalar as fn
from fleetlake.operators import filters, joins
from fleetlake.operators import aggregates as agg
from fleetlake.operators import sets
from fleetlake.quality import checks
from fleetlake.sources import tables as src


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def test_sums_are_exact_and_ignore_nulls(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(-0.3,), (None,), (123456789.01,)], "x double")
    r = df.agg(fn.dsum("x").alias("s"), fn.davg("x").alias("m"), fn.msum("x").alias("d")).first()
    assert r["s"] == 123456789.71 and str(r["d"]) == "123456789.7100"
    assert r["m"] == 123456789.71 / 12
    empty = df.limit(0).agg(fn.dsum("x").alias("s"), fn.davg("x").alias("m"), fn.sum_if(F.col("x") > 0, "x").alias("z")).first()
    assert empty["s"] is None and empty["m"] is None and empty["z"] == 0.0


def test_sum_survives_large_totals(spark):
    df = spark.range(1000).select(F.lit(9e11).alias("x"))
    assert df.agg(fn.dsum("x")).first()[0] == 9e14


def test_ratios_with_zero(spark):
    r = one(spark, a=fn.ratio(F.lit(1), F.lit(0)), b=fn.pct(F.lit(1), F.lit(4)), c=fn.ratio(F.lit(None).cast("int"), F.lit(2)))
    assert r == {"a": None, "b": 25.0, "c": None}


def test_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (None, -1, 0, 1, 30, 31, 99)], "x int")
    rows = df.select("x", fn.case_bucket("x", [0, 30], ["none", "some", "many"]).alias("b"), fn.cut("x", [0, 30, 60], ["low", "mid"]).alias("c")).collect()
    assert [r["b"] for r in rows] == [None, "none", "none", "some", "some", "many", "many"]
    assert [r["c"] for r in rows] == [None, None, None, "low", "low", "mid", None]
    with pytest.raises(ValueError):
        fn.case_bucket("x", [1], ["a"])


def test_boundary_differences(spark):
    a, b = F.lit("2024-01-31 23:59:00").cast("timestamp"), F.lit("2024-02-01 00:01:00").cast("timestamp")
    r = one(spark, h=fn.hours_between(a, b), d=fn.days_between(a, b), m=fn.months_between(a, b), back=fn.days_between(b, a))
    assert r == {"h": 1, "d": 1, "m": 1, "back": -1}


def test_periods(spark):
    ts = F.lit("2024-08-31 15:30:00").cast("timestamp")
    want = {
        "hourly": (datetime(2024, 8, 31, 15), datetime(2024, 8, 31, 15, 59, 59)), "weekly": (datetime(2024, 8, 26), datetime(2024, 9, 1, 23, 59, 59)),
        "monthly": (datetime(2024, 8, 1), datetime(2024, 8, 31, 23, 59, 59)), "quarterly": (datetime(2024, 7, 1), datetime(2024, 9, 30, 23, 59, 59)),
        "bi-annual": (datetime(2024, 7, 1), datetime(2024, 12, 31, 23, 59, 59)), "annual": (datetime(2024, 1, 1), datetime(2024, 12, 31, 23, 59, 59)),
    }
    for period, bounds in want.items():
        s, e = filters.period_bounds(ts, period)
        row = spark.range(1).select(F.date_format(s, "yyyy-MM-dd HH:mm:ss"), F.date_format(e, "yyyy-MM-dd HH:mm:ss")).first()
        assert tuple(row) == tuple(x.strftime("%Y-%m-%d %H:%M:%S") for x in bounds), period
    with pytest.raises(ValueError):
        filters.period_bounds(ts, "fortnightly")


def test_labels(spark):
    r = one(
        spark, i=fn.make_id("TR", F.lit(42), 6), wide=fn.make_id("TR", F.lit(12345678), 6), k=fn.money_label(F.lit(1500.0)), m=fn.money_label(F.lit(2.54e6)), b=fn.money_label(F.lit(3.456e9)),
        c=fn.clip(F.lit(None).cast("double"), 0.0, 1.0),
    )
    assert r == {"i": "TR000042", "wide": "TR12345678", "k": "PKR 2K", "m": "PKR 2.5M", "b": "PKR 3.46B", "c": None}


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("31/31/2024",), (None,)], "t string")
    assert [r.t is None for r in src.normalise_dates(df, ["t"]).collect()] == [False, True, True]


def test_missing_table_without_schema(spark, tmp_path):
    with pytest.raises(AnalysisException):
        src.load_table(spark, str(tmp_path), "nothing")
    (tmp_path / "t.csv").write_text("a,b\n1,x\nbad,y\n")
    rows = src.load_table(spark, str(tmp_path), "t", "a int, b string").collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x"), (None, "y")]


def test_sheet_filter_reads_text_as_the_column_type(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Num int, Name string")
    assert filters.sheet_filter(df, "NUM", "2").first()["Name"] == "b"
    with pytest.raises(ValueError):
        filters.sheet_filter(df, "missing", "2")


def test_joins_with_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    got = {(r.left_key, r.right_key, r.status) for r in joins.reconcile(left, right, "k").collect()}
    assert {(1, None, "Never used"), (2, 2, "Matched"), (None, 3, "Orphan")} <= got


def test_asof_takes_the_last_entry(spark):
    line = spark.createDataFrame([("a", date(2024, 1, 10), 1.0), ("a", date(2024, 3, 5), 2.0), ("b", date(2024, 1, 1), 9.0)], "g string, since date, price double")
    facts = spark.createDataFrame(
        [(1, "a", date(2024, 1, 9)), (2, "a", date(2024, 1, 10)), (3, "a", date(2024, 3, 4)), (4, "a", date(2024, 3, 5)), (5, "a", date(2025, 7, 1)), (6, "c", date(2024, 2, 1)), (7, None, date(2024, 2, 1))],
        "id int, g string, d date",
    )
    got = {r.id: r.price for r in joins.asof_join(facts, line, ["g"], "d", "since", "price", default=220.0).collect()}
    assert got == {1: 220.0, 2: 1.0, 3: 1.0, 4: 2.0, 5: 2.0, 6: 220.0, 7: 220.0}


def test_conflicts_are_linked_not_paired(spark):
    df = spark.createDataFrame([(i, "car", date(2024, 1, 1)) for i in range(50)] + [(99, "bus", date(2024, 1, 1))], "id int, v string, d date")
    rows = joins.same_group_conflicts(df, ["v", "d"], "id").collect()
    assert len(rows) == 50 and {r.conflicts for r in rows} == {49}
    assert sorted((r.id, r.next_id) for r in rows)[:2] == [(0, 1), (1, 2)]


def test_first_values_of_many(spark):
    assert joins.first_values(spark.range(20).withColumnRenamed("id", "x"), "x", 12) == list(range(12))


def test_totals_of_totals_do_not_overflow(spark):
    from fleetlake.operators.aggregates import share_of_total

    df = spark.createDataFrame([("a", 7.5e15), ("b", 2.5e15), ("c", float("nan"))], "k string, v double")
    got = {r["k"]: r["share"] for r in share_of_total(df, "v", "share").collect()}
    assert (got["a"], got["b"]) == (75.0, 25.0)
    assert df.agg(fn.wide_sum("v")).first()[0] == 1e16
    one = spark.createDataFrame([(1.25,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert one.agg(fn.dsum("v")).first()[0] == 1.25
    assert [r[0] for r in one.select(fn.money("v").cast("double")).collect()] == [1.25, None, None, None]

def test_sets(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in sets.upsert(target, delta, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(tuple(r) for r in sets.insert_new(target, delta, ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "C")]
    assert sets.upsert(sets.upsert(target, delta, ["k"]), delta, ["k"]).count() == 3


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [tuple(r) for r in agg.histogram(df, "v", 4).collect()] == [(0, 2)]


def test_table_summary_counts_nulls_and_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "x int, y string")
    r = checks.table_summary(df, "t").first()
    assert (r.total, r.null_rows, r.duplicates, r.status) == (6, 2, 3, "Bad")


def test_rules_and_quarantine(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 50.0), (None, "z", None)], "k int, s string, v double")
    rules = [
        checks.Rule("key", "not_null", "k"), checks.Rule("range", "range", "v", {"low": 0, "high": 10}), checks.Rule("values", "accepted_values", "s", {"values": ["a", "b"]}),
        checks.Rule("once", "unique", "k"), checks.Rule("share", "threshold", "v", {"condition": F.col("v") > 10, "limit": 40.0}),
        checks.Rule("parent", "referential", "s", {"parent": spark.createDataFrame([("a",), ("a",)], "p string"), "parent_column": "p"}),
    ]
    got = {r.rule: (r.checked, r.failed, r.passed) for r in checks.run_rules(df, "t", rules).collect()}
    assert got == {"key": (3, 1, False), "range": (3, 1, False), "values": (3, 1, False), "once": (3, 1, False), "share": (3, 1, True), "parent": (3, 2, False)}
    good, bad = checks.split_quarantine(df, {"no key": F.col("k").isNull(), "large": F.col("v") > 10})
    assert good.count() == 1 and sorted(r.reject_reason for r in bad.collect()) == ["large", "no key"]
    flagged = checks.flag_rows(df, {"large": F.col("v") > 10}).collect()
    assert [r["_dq_large"] for r in flagged] == [False, True, False]
    log = checks.issue_log(df.union(df), "t", F.col("s"), {"no_key": F.col("k").isNull(), "large": F.col("v") > 10})
    assert {tuple(r) for r in checks.issue_counts(log).collect()} == {("t", "large", 2, 1), ("t", "no_key", 2, 1)}
    assert {(r.row_key, r.check_name) for r in checks.issue_log(df, "t", F.col("s"), {"no_key": F.col("k").isNull(), "large": F.col("v") > 10}).collect()} == {("b", "large"), ("z", "no_key")}


def test_issues_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(checks, "ROWS_PER_FILE", 1000)
    monkeypatch.setattr(checks, "KEYS_PER_TASK", 500)
    log = checks.issue_log(spark.range(20_000, numPartitions=4), "t", F.col("id") % 7000, {"all": F.lit(True), "odd": F.col("id") % 2 == 1, "none": F.lit(False)})
    sizes = [r.n for r in checks.dealt_issues(log, 20_000, 3).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 10_000
    assert {tuple(r) for r in checks.issue_counts(log).collect()} == {("t", "all", 20_000, 7000), ("t", "odd", 10_000, 3500)}
