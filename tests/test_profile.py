"""Profiles from one count of all values."""

from datetime import date

from fleetlake.quality import profile


def test_profile_of_odd_columns(spark):
    rows = [(1, 0.0, 0.1, None, date(2024, 1, 1), True), (2, -0.0, 0.1, None, None, True), (2, float("nan"), 2.5, None, date(2024, 1, 1), None), (None, 7.25, 2.5, None, date(2024, 1, 2), False)]
    df = spark.createDataFrame(rows, "`a.b` int, v double, f float, nothing string, d date, flag boolean")
    got = {r["column_name"]: r for r in profile.profile_columns(df).collect()}
    assert (got["a.b"]["nulls"], got["a.b"]["distinct_values"], got["a.b"]["lowest"], got["a.b"]["highest"], got["a.b"]["top_values"]) == (1, 2, 1.0, 2.0, "2 (2), 1 (1)")
    assert got["a.b"]["mean"] == 5 / 3
    assert (got["v"]["distinct_values"], got["v"]["top_values"].split(",")[0]) == (3, "0.0 (2)")
    assert got["f"]["lowest"] == spark.sql("select double(float(0.1))").first()[0]
    assert (got["nothing"]["nulls"], got["nothing"]["distinct_values"], got["nothing"]["top_values"], got["nothing"]["health"]) == (4, 0, None, "Bad")
    assert (got["d"]["distinct_values"], got["d"]["lowest"], got["flag"]["top_values"]) == (2, None, "true (2), false (1)")


def test_profile_of_an_empty_table(spark):
    got = profile.profile_columns(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["column_name"], r["row_count"], r["distinct_values"], r["null_pct"]) for r in sorted(got)] == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]


def test_one_scan_and_one_wide_exchange(spark, tables):
    lines = tables["lineitem"].select("l_partkey", "l_extendedprice", "l_returnflag")
    df = profile.profile_columns(lines)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # both branches read the counts of (place, value) from one shuffle
    assert "ReusedExchange" in final
    assert final.count("Scan parquet") == 1
