from datetime import datetime, timedelta

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from fleetlake.models import features, forecast, stats, training
from fleetlake.operators import scale
from fleetlake.plans import customers, reports
from fleetlake.quality import profile
from fleetlake.session import scratch_path
from fleetlake.streaming import streams

SCHEMA = "id bigint, ts timestamp, k string, v double"
T0 = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(hours=h), k, float(v)) for i, h, k, v in rows], SCHEMA)


def drop(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_append_reads_new_files_only(spark):
    folder, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    a, b = events(spark, [(1, 0, "a", 1), (2, 1, "b", 2)]), events(spark, [(3, 2, "a", 3)])
    for part, total in ((a, 2), (b, 3)):
        drop(part, folder)
        for _ in range(2):
            streams.append(streams.source(spark, folder, a.schema), out, state)
            assert spark.read.parquet(out).count() == total


def test_upsert_is_idempotent_and_compacts(spark):
    folder, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = events(spark, []).schema if False else spark.createDataFrame([], SCHEMA).schema
    drop(events(spark, [(1, 0, "a", 1), (2, 0, "b", 2)]), folder)
    streams.upsert(streams.source(spark, folder, schema), out, state)
    drop(events(spark, [(1, 5, "a", 9), (3, 0, "c", 3)]), folder)
    streams.upsert(streams.source(spark, folder, schema), out, state)
    want = [(1, 9.0), (2, 2.0), (3, 3.0)]
    now = streams.current(spark, out, ["id"], ["-ts"])
    assert sorted((r.id, r.v) for r in now.collect()) == want
    # a replayed batch replaces its own folder
    streams.write_batch(out)(events(spark, [(1, 5, "a", 9), (3, 0, "c", 3)]), 1)
    assert sorted((r.id, r.v) for r in streams.current(spark, out, ["id"], ["-ts"]).collect()) == want
    packed = scratch_path(spark, "packed")
    streams.compact(spark, out, packed, ["id"], ["-ts"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(packed).collect()) == want


def test_late_rows_are_logged(spark):
    folder = scratch_path(spark, "in")
    paths = {n: scratch_path(spark, n) for n in ("accepted", "late", "progress", "state")}
    each = streams.split_late("ts", "2 hours", paths["accepted"], paths["late"], paths["progress"])
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in ([(1, 10, "a", 1)], [(2, 9, "a", 1), (3, 7, "a", 1), (4, 12, "a", 1)], [(5, 9.5, "a", 1)]):
        drop(events(spark, rows), folder)
        streams.drain(streams.source(spark, folder, schema), paths["state"], each=each)
    assert sorted(r.id for r in spark.read.parquet(paths["accepted"]).collect()) == [1, 2, 4]
    assert sorted(r.id for r in spark.read.parquet(paths["late"]).collect()) == [3, 5]


def test_file_names_give_the_table(spark):
    df = spark.createDataFrame([("/x/oltp_trips_stream_20240101.csv",), ("/x/other.csv",)], "f string")
    assert [r[0] for r in df.select(streams.table_of(F.col("f"))).collect()] == ["oltp_trips", ""]


def test_rfm_best_is_five_and_legacy_inverts(spark):
    raw = spark.createDataFrame([(i, i * 10, 11 - i, 1000.0 - i) for i in range(1, 11)], "c int, recency_days int, frequency int, monetary double")
    now = {r.c: (r.r_score, r.f_score, r.m_score, r.rfm_segment) for r in customers.rfm_scores(raw, "c").collect()}
    assert now[1] == (5, 5, 5, "Champion") and now[10] == (1, 1, 1, "Lost")
    old = {r.c: (r.r_score, r.f_score, r.m_score) for r in customers.rfm_scores(raw, "c", legacy_scores=True).collect()}
    assert old[1] == (1, 1, 1) and old[10] == (5, 5, 5)


def test_quantile_scores_with_equal_edges(spark):
    df = spark.createDataFrame([(i, float(min(i, 3))) for i in range(10)] + [(99, None)], "i int, x double")
    got = {r.i: r.s for r in stats.quantile_scores(df, {"s": ("x", False)}).collect()}
    assert got[0] == 1 and got[99] is None and got[9] == got[3]


def test_zscore_of_single_rows(spark):
    df = spark.createDataFrame([("a", 1.0)] + [("b", float(x)) for x in [1] * 20 + [100]], "k string, v double")
    out = stats.zscore_anomalies(df, "k", "v").collect()
    assert [(r.k, r.v) for r in out] == [("b", 100.0)]


def test_distribution_matches_pandas(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.5, 3.0, 7.0, 11.0, 40.0]
    r = profile.distribution(spark.createDataFrame([(v,) for v in values], "x double"), "x").first()
    s = pd.Series(values)
    assert np.allclose([r.mean, r["std"], r.skew, r.kurt, r.p25, r.median, r.p95], [s.mean(), s.std(), s.skew(), s.kurt(), s.quantile(0.25), s.median(), s.quantile(0.95)])


def test_kpi_flags(spark):
    m = spark.createDataFrame([("cancel_rate", 5.0), ("cancel_rate", 10.0), ("safety_score", 50.0), ("collection_rate", 92.0)], "metric string, value double")
    assert sorted((r.metric, r.value, r.level) for r in reports.kpi_flags(m).collect()) == [
        ("cancel_rate", 5.0, "good"), ("cancel_rate", 10.0, "warn"), ("collection_rate", 92.0, "good"), ("safety_score", 50.0, "bad")
    ]


def test_holt_winters_repeats_a_seasonal_line():
    t = np.arange(48)
    y = 100 + 2 * t + 10 * np.sin(2 * np.pi * t / 12)
    ahead = np.arange(48, 54)
    want = 100 + 2 * ahead + 10 * np.sin(2 * np.pi * ahead / 12)
    assert np.max(np.abs(forecast.best_forecast(y, 6) - want) / want) < 0.1
    assert forecast.best_forecast(np.array([5.0, 5.0]), 3).shape == (3,)


def test_forecast_fills_missing_months(spark):
    rows = [("a", datetime(2023, 1 + i % 12, 3), 100.0) for i in range(12) if i != 4] + [("b", datetime(2024, 5, 1), 7.0)]
    out = forecast.revenue_forecast(spark.createDataFrame(rows, "k string, ts timestamp, amount double"), "k", "ts", "amount", 2).collect()
    assert sorted((r.k, str(r.month)) for r in out) == [("a", "2024-01-01"), ("a", "2024-02-01"), ("b", "2024-06-01"), ("b", "2024-07-01")]
    assert all(abs(r.upper - r.forecast * 1.15) < 1e-9 for r in out)


def test_hash_split_is_stable(spark):
    df = spark.range(2000)
    _, test = features.hash_split(df, "id", 0.2)
    _, again = features.hash_split(df.repartition(7), "id", 0.2)
    assert sorted(r.id for r in test.collect()) == sorted(r.id for r in again.collect())
    assert 300 < test.count() < 500


def test_maintenance_label_looks_ahead(spark):
    from datetime import date

    m = spark.createDataFrame([(1, 7, date(2024, 1, 1), "A"), (2, 7, date(2024, 1, 10), "B"), (3, 7, date(2024, 6, 1), "A"), (4, 8, date(2024, 1, 1), "A")], "maint_id int, vehicle_id int, maintenance_date date, maintenance_type string")
    v = spark.createDataFrame([(7, 2020, 1000)], "vehicle_id int, year int, odometer_km int")
    got = {r.maint_id: (r.days_since_last, r.upcoming, r.vehicle_age) for r in features.maintenance(m, v, 2024).collect()}
    assert got == {1: (90, 1, 4), 2: (9, 0, 4), 3: (143, 0, 4), 4: (90, 0, None)}


def test_models_learn_a_clear_rule(spark):
    rows = [(i, float(i % 10), float(i % 3), 0.0, 0.0, "good" if i % 10 < 5 else "poor") for i in range(600)]
    df = spark.createDataFrame(rows, "telem_id bigint, harsh_brakes double, harsh_accels double, idle_minutes double, speeding_km double, profile string")
    model, scored = training.train_safety(df, trees=5, depth=3)
    report = {r.metric: r.value for r in training.classification_report(scored).collect()}
    assert report["accuracy"] == 1.0 and report["f1_0"] == 1.0
    new = training.class_probabilities(model, df.drop("profile").limit(3)).first()
    assert new.p_good + new.p_poor == 100.0
    top = training.feature_importance(scored, model, training.SAFETY_FEATURES, 2).orderBy(F.desc("importance")).first()
    assert top.feature == "harsh_brakes"


def test_demand_accepts_unseen_cities(spark):
    from datetime import date

    rows = [(date(2024, 1, 1) + timedelta(days=i), c, 10 + 5 * (c == "B")) for i in range(60) for c in "AB"]
    frame = spark.createDataFrame(rows, "day date, city string, trip_count bigint").withColumns(features.calendar("day"))
    model, scored = training.train_demand(frame, trees=5)
    assert {r.metric for r in training.regression_report(scored).collect()} == {"mae", "rmse", "r2"}
    cities = spark.createDataFrame([("A",), ("B",), ("new",)], "city string")
    out = training.forecast_demand(model, cities, "2024-03-01", days=3)
    assert out.count() == 9 and out.agg(F.min("predicted_trips")).first()[0] >= 0


def test_outlook_of_a_forecast(spark):
    from datetime import date

    from fleetlake.models import forecast

    series = spark.createDataFrame([(1, date(2024, 5, 1), 120.0), (1, date(2024, 6, 1), 180.0), (1, date(2024, 7, 1), 90.0)], "k int, month date, forecast double")
    row = forecast.outlook(series, spark.createDataFrame([(1, 100.0)], "k int, last_actual double"), "k").first()
    assert (row.next_forecast, row.mean_forecast, row.peak_month, row.peak, row.growth_pct) == (120.0, 130.0, date(2024, 6, 1), 180.0, 20.0)


def test_cells_give_the_same_boosted_trees(spark):
    frame = spark.range(3000).selectExpr(
        "id AS trip_id", "int(id % 12 + 1) AS month", "int(id * 7919 % 7) AS dow", "int(id * 7919 % 7 >= 5) AS is_weekend", "concat('c', id % 5) AS city", "concat('b', id % 3) AS booking_type",
        "double(id * 31 % 20) AS distance_km", "double(id % 12 * 10 + id % 5 + id * 31 % 20 + id * 104729 % 1009 / 100) AS fare_per_day",
    )
    _, by_row = training.train_pricing(frame, trees=8, depth=3)
    model, by_cell = training.train_pricing(frame, trees=8, depth=3, most=100)
    assert isinstance(model.stages[2].stages[0], SQLTransformer)
    a, b = ({r.trip_id: r.prediction for r in s.collect()} for s in (by_row, by_cell))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_every_row_counts_in_cells_of_a_forest(spark, monkeypatch):
    stored, write = {}, training.materialise
    monkeypatch.setattr(training, "materialise", lambda df, label: stored.setdefault(label, write(df, label)))
    df = spark.range(20_000).selectExpr(
        "id AS telem_id", "id * 3 % 40 + id / 1e6 AS harsh_brakes", "double(id % 3) AS harsh_accels", "double(id % 9 = 0) AS idle_minutes", "IF(id % 7 = 0, 0D, 1D) AS speeding_km", "IF(id * 3 % 40 < 20, 'good', 'poor') AS profile"
    )
    model, scored = training.train_safety(df, trees=5, depth=4, most=2000)
    train, _ = features.hash_split(df, "telem_id", training.TEST_SHARES["safety"])
    got = stored["instances"].agg(F.sum("weight").alias("w"), F.count("*").alias("n"), F.max("weight").alias("top")).first()
    assert abs(got.w - train.count()) < 1e-6 and got.top <= 10 and 1600 <= got.n < 6000
    assert {r.metric: r.value for r in training.classification_report(scored).collect()}["accuracy"] > 0.95
    top = training.feature_importance(scored, model, ["harsh_brakes", "harsh_accels", "idle_minutes", "speeding_km"], 2).orderBy(F.desc("importance")).first()
    assert top.feature == "harsh_brakes"


def test_bins_keep_few_values_apart_and_see_small_shares(spark):
    df = spark.range(10_000).selectExpr("IF(id % 3 = 0, NULL, double(id % 5)) AS few", "IF(id % 10 > 0, 0D, double(id)) AS many", "double('NaN') AS none")
    edges = training._edges(df, ["few", "many", "none"], 32)
    assert edges["few"] == [0.5, 1.5, 2.5, 3.5] and edges["none"] == []
    assert len(edges["many"]) > 20 and edges["many"][0] == 0.0 and edges["many"][-1] > 9000
    got = df.selectExpr(f"{training._bin_sql('few', edges['few'])} AS bin", "few").distinct().collect()
    assert {(r.few, r.bin) for r in got} == {(None, None)} | {(float(i), float(i)) for i in range(5)}
