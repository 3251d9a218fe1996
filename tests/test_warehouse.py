from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.sets import upsert
from fleetlake.session import scratch_path
from fleetlake.sources import sinks
from fleetlake.warehouse import dims, load, rules

TRACKED = ["name", "city"]


def customers(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, city string")


def versions(dim):
    return sorted((r.id, r.name, r.city, str(r.valid_from), str(r.valid_to), r.is_current) for r in dim.collect())


def test_scd2_new_changed_unchanged_vanished(spark):
    dim = dims.scd2_initial(customers(spark, [(1, "A", "X"), (2, "B", None), (3, "C", "Z")]), "2024-01-01")
    batch = customers(spark, [(1, "A", "Y"), (2, "B", None), (4, "D", "W")])
    out = dims.scd2_apply(dim, batch, "id", TRACKED, "2024-03-01")
    want = [
        (1, "A", "X", "2024-01-01", "2024-02-29", False), (1, "A", "Y", "2024-03-01", "9999-12-31", True), (2, "B", None, "2024-01-01", "9999-12-31", True),
        (3, "C", "Z", "2024-01-01", "9999-12-31", True), (4, "D", "W", "2024-03-01", "9999-12-31", True),
    ]
    assert versions(out) == sorted(want, key=lambda r: (r[0], r[1], str(r[2]), r[3]))
    again = dims.scd2_apply(out, batch, "id", TRACKED, "2024-03-01")
    assert versions(again) == versions(out)
    corrected = dims.scd2_apply(out, customers(spark, [(1, "A", "V")]), "id", TRACKED, "2024-03-01")
    one = [v for v in versions(corrected) if v[0] == 1]
    assert one == [(1, "A", "V", "2024-03-01", "9999-12-31", True), (1, "A", "X", "2024-01-01", "2024-02-29", False)]


def test_null_to_value_is_a_change(spark):
    dim = dims.scd2_initial(customers(spark, [(2, "B", None)]), "2024-01-01")
    out = dims.scd2_apply(dim, customers(spark, [(2, "B", "X")]), "id", TRACKED, "2024-02-01")
    assert out.count() == 2 and out.where("is_current").first().city == "X"


def test_surrogate_keys_and_unknown_member(spark):
    dim = dims.with_surrogate_keys(customers(spark, [(30, "A", "X"), (10, "B", "Y")]), "id", "sk", {"id": -1, "name": "Unknown"})
    assert {(r.id, r.sk) for r in dim.collect()} == {(10, 1), (30, 2), (-1, -1)}
    facts = spark.createDataFrame([(1, 30), (2, 99), (3, None)], "f int, id int")
    assert {(r.f, r.sk) for r in dims.lookup(facts, dim, "id", "sk").collect()} == {(1, 2), (2, -1), (3, -1)}


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2023, 12, 30, 5),), (datetime(2024, 1, 2),)], "ts timestamp")
    rows = dims.dim_date(df, "ts", ["01-01", "2024-01-02"]).orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [20231230, 20231231, 20240101, 20240102]
    assert [r.is_weekend for r in rows] == [True, True, False, False]
    assert [r.is_holiday for r in rows] == [False, False, True, True]
    assert rows[2].quarter_label == "2024-Q1"


def test_incremental_equals_full(spark):
    full = spark.createDataFrame([(i, date(2024, 1 + i % 6, 1 + i % 28), float(i)) for i in range(200)], "id int, d date, v double")
    path = scratch_path(spark, "merge-test")
    load.write_months(full.where("id < 150"), path, "d")
    delta = full.where("id >= 100").withColumn("v", F.col("v") * 2)
    for _ in range(2):  # the same delta twice
        load.merge_months(spark, path, delta, "d", ["id"])
    want = upsert(full.where("id < 150"), delta, ["id"])
    got = spark.read.parquet(path).select("id", "d", "v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_merge_leaves_other_months_alone(spark):
    path = scratch_path(spark, "untouched")
    df = spark.createDataFrame([(1, date(2024, 1, 1), 1.0), (2, date(2024, 2, 1), 2.0)], "id int, d date, v double")
    load.write_months(df, path, "d")
    def files():
        return {r.f for r in spark.read.parquet(path).where("month_key = '2024-01'").select(F.col("_metadata.file_path").alias("f")).collect()}

    before = files()
    load.merge_months(spark, path, df.where("id = 2").withColumn("v", F.lit(5.0)), "d", ["id"])
    assert files() == before


def test_state_and_watermark(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3))], "id int, ts timestamp")
    empty = load.read_state(spark, scratch_path(spark, "no-state"))
    assert load.after_watermark(df, "ts", empty, "t").count() == 2
    state = load.measure_state({"t": (df.where("id = 1"), "ts")})
    assert sorted(r.id for r in load.after_watermark(df, "ts", state, "t").collect()) == [1, 2]  # the boundary row comes again
    got = {r.table_name: (r.new_rows, r.action) for r in load.detect_new_rows(load.measure_state({"t": (df, "ts"), "u": (df, "ts")}), state).collect()}
    assert got == {"t": (1, "incremental load"), "u": (2, "full load")}


def test_steps_are_isolated(spark):
    def fail():
        raise RuntimeError("broken")

    rows = sinks.run_steps(spark, {"a": lambda: 1, "b": fail, "c": lambda: 3}).collect()
    assert [(r.step, r.status, r.row_count, r.message) for r in rows] == [("a", "ok", 1, None), ("b", "failed", None, "broken"), ("c", "ok", 3, None)]


def test_lineage_with_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "source string, target string")
    start = spark.createDataFrame([("a",)], "node string")
    assert {(r.node, r.depth) for r in load.lineage(edges, start).collect()} == {("b", 1), ("c", 2), ("d", 3)}
    up = load.lineage(edges, spark.createDataFrame([("d",)], "node string"), downstream=False)
    assert {(r.node, r.depth) for r in up.collect()} == {("c", 1), ("b", 2), ("a", 3)}


def test_eav_values_that_do_not_parse(spark):
    df = spark.createDataFrame([(1, "seats", "4"), (1, "gps", "yes"), (2, "seats", "four")], "id int, attr_name string, attr_value string")
    got = {r.id: (r.seats, r.gps) for r in load.eav_pivot(df, "id", {"seats": "int", "gps": "string"}).collect()}
    assert got == {1: (4, "yes"), 2: (None, None)}


def test_stage(spark):
    raw = spark.createDataFrame([(" 1 ", " ali khan ", "5"), ("1", "ali khan", "7"), ("2", None, "x"), ("3", "sara", "-4")], "id string, name string, km string")
    out = load.stage(raw, {"id": "int", "km": "double"}, {"km": 0.0}, ["id"], ["-km", "name"], floors={"km": 0.0}, names=["name"], flags={"zero_km": F.col("km") == 0})
    assert sorted((r.id, r.name, r.km, r._dq_zero_km) for r in out.collect()) == [(1, "Ali Khan", 7.0, False), (2, None, 0.0, True), (3, "Sara", 0.0, True)]


def test_invoice_rules(spark):
    trips = spark.createDataFrame(
        [(1, 7, datetime(2024, 1, 1, 23), 1000.0, "Airport Transfer"), (2, 7, datetime(2024, 1, 31, 12), 1000.0, "City Ride"), (3, 7, datetime(2024, 1, 1, 5, 59), 105.0, "City Ride")],
        "trip_id int, customer_id int, pickup timestamp, base_fare double, booking_type string",
    )
    share = F.when(F.col("trip_id") == 1, 0.5).when(F.col("trip_id") == 2, 1.0).otherwise(0.0)
    inv = rules.derive_invoice(trips, 4000.0, share, F.when(F.col("trip_id") == 2, 100.0).otherwise(0.0))
    got = {r.trip_id: (r.total, r.paid, r.payment_status, str(r.due_date)) for r in inv.collect()}
    assert got == {1: (5100.0, 2550.0, "Partial", "2024-01-08"), 2: (900.0, 900.0, "Paid", "2024-02-07"), 3: (116.0, 0.0, "Unpaid", "2024-01-08")}
    lines = rules.derive_line_items(inv).groupBy("trip_id").agg(F.sum("amount").alias("s"), F.count("*").alias("n"))
    assert {r.trip_id: (r.s, r.n) for r in lines.collect()} == {1: (5100.0, 3), 2: (900.0, 2), 3: (116.0, 2)}


def test_fuel_prices_and_scores(spark):
    line = [("2024-01-01", 10.0, 20.0, 30.0), ("2024-07-01", 11.0, 21.0, 31.0)]
    df = spark.createDataFrame([("Petrol", date(2023, 12, 31)), ("Diesel", date(2024, 6, 30)), ("CNG", date(2024, 7, 1)), ("Hybrid", date(2025, 1, 1))], "t string, d date")
    assert [r[0] for r in df.select(rules.fuel_price(F.col("t"), F.col("d"), line)).collect()] == [220.0, 20.0, 31.0, 11.0]
    lit = F.lit
    scores = spark.range(1).select(rules.safety_score(lit(0), lit(0), lit(0), lit(0.0)), rules.safety_score(lit(100), lit(0), lit(0), lit(0.0)), rules.safety_score(lit(2), lit(1), lit(20), lit(10.0))).first()
    assert tuple(scores) == (100.0, 0.0, 92.0)


def invoices(spark, rows):
    return spark.createDataFrame(rows, "id int, d date, v double")


def test_merge_moves_rows_between_months(spark):
    path = scratch_path(spark, "moved")
    load.write_months(invoices(spark, [(1, date(2024, 1, 5), 1.0), (2, date(2024, 1, 9), 2.0), (3, date(2024, 2, 2), 3.0), (4, date(2024, 3, 3), 4.0)]), path, "d")
    delta = invoices(spark, [(1, date(2024, 2, 20), 10.0), (4, date(2024, 2, 21), 40.0), (5, date(2024, 4, 1), 5.0)])
    want = [(1, "2024-02-20", 10.0), (2, "2024-01-09", 2.0), (3, "2024-02-02", 3.0), (4, "2024-02-21", 40.0), (5, "2024-04-01", 5.0)]
    for _ in range(2):  # the same delta again changes nothing
        load.merge_months(spark, path, delta, "d", ["id"])
        assert sorted((r.id, str(r.d), r.v) for r in spark.read.parquet(path).collect()) == want


def test_watermark_keeps_rows_of_its_own_day(spark):
    state = spark.createDataFrame([("t", 2, datetime(2024, 1, 9))], load.STATE_SCHEMA)
    df = invoices(spark, [(1, date(2024, 1, 8), 1.0), (2, date(2024, 1, 9), 2.0), (3, date(2024, 1, 9), 3.0), (4, date(2024, 1, 10), 4.0)])
    assert sorted(r.id for r in load.after_watermark(df, "d", state, "t").collect()) == [2, 3, 4]
    assert load.after_watermark(df, "d", state, "other").count() == 4


def test_lineage_goes_to_the_end_or_raises(spark):
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(104)], "source string, target string")
    start = spark.createDataFrame([("0",)], "node string")
    assert load.lineage(edges, start).agg(F.max("depth")).first()[0] == 104
    with pytest.raises(ValueError, match="deeper than 3"):
        load.lineage(edges, start, max_depth=3)
