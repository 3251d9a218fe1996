"""Statistics, feature frames and models on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF
from fleetlake.catalog.queries import DONE, regression_frame, _REG
from fleetlake.catalog.registry import A, CI, D, M, ORACLES, P, S, TS, query
from fleetlake.functions.scalar import dsum, rows
from fleetlake.models import features, forecast, stats, training
from fleetlake.operators.sets import union_all
from fleetlake.plans.customers import rfm_raw
from fleetlake.quality import profile
from fleetlake.session import materialise


def fitted(t, name, fit):
    """A model and its scored test rows, trained once per opened folder however many queries report on it."""
    known = t.__dict__.setdefault("fitted", {})
    if name not in known:
        model, scored = fit()
        known[name] = (model, materialise(scored, f"scored-{name}"))
    return known[name]


def safety_model(t):
    return fitted(t, "safety", lambda: training.train_safety(features.safety(t["telematics"], t["telem_drivers"], training.SAFETY_FEATURES)))


def pricing_model(t):
    return fitted(t, "pricing", lambda: training.train_pricing(pricing_frame(t)))


@query(
    "zscore_anomalies",
    """WITH s AS (SELECT vehicle_id, AVG(efficiency) AS m, COALESCE(STDDEV_SAMP(efficiency), 1) AS sd FROM fuel_logs GROUP BY 1)
        SELECT fuel_type, COUNT(*) AS n, COUNT(DISTINCT vehicle_id) AS vehicles, ROUND(MIN((efficiency - m) / NULLIF(sd, 0)), 4) AS lowest_z, ROUND(MAX((efficiency - m) / NULLIF(sd, 0)), 4) AS highest_z
        FROM fuel_logs JOIN s USING (vehicle_id) WHERE ABS((efficiency - m) / NULLIF(sd, 0)) > 2 GROUP BY 1""",
)
def _(t):
    z = stats.zscore_anomalies(t["fuel_logs"], "vehicle_id", "efficiency")
    return z.groupBy("fuel_type").agg(
        rows().alias("n"), F.count_distinct("vehicle_id").alias("vehicles"), F.round(F.min("z_score"), 4).alias("lowest_z"), F.round(F.max("z_score"), 4).alias("highest_z")
    )


@query(
    "iqr_outliers",
    """WITH q AS (SELECT QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM events)
        SELECT COUNT(*) AS row_count, COUNT(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers FROM events, q""",
)
def _(t):
    return profile.outliers(t["events"], "value").select("row_count", "outliers")


_RFM = f"""WITH raw AS (SELECT customer_id, DATE_DIFF('day', MAX(invoice_date), DATE '{AS_OF}') AS recency_days, COUNT(*) AS frequency, {S('total_amount')} AS monetary FROM invoices GROUP BY 1),
    e AS (SELECT QUANTILE_CONT(recency_days, [0.2, 0.4, 0.6, 0.8]) AS r, QUANTILE_CONT(frequency, [0.2, 0.4, 0.6, 0.8]) AS f, QUANTILE_CONT(monetary, [0.2, 0.4, 0.6, 0.8]) AS m FROM raw),
    s AS (SELECT raw.*, 5 - LEN(LIST_FILTER(r, lambda x: recency_days > x)) AS r_score, 1 + LEN(LIST_FILTER(f, lambda x: frequency > x)) AS f_score, 1 + LEN(LIST_FILTER(m, lambda x: monetary > x)) AS m_score FROM raw, e)"""


@query(
    "rfm_qcut",
    _RFM + """ SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score, CASE WHEN r_score + f_score + m_score <= 5 THEN 'At Risk'
        WHEN r_score + f_score + m_score <= 8 THEN 'Regular' WHEN r_score + f_score + m_score <= 11 THEN 'Loyal' ELSE 'Champion' END AS segment FROM s""",
)
def _(t):
    raw = rfm_raw(t["invoices"], "customer_id", "invoice_date", "invoice_id", "total_amount", AS_OF)
    s = stats.quantile_scores(raw, {"r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary", False)})
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return s.withColumn("rfm_score", total).withColumn("segment", stats.segment("rfm_score"))


@query(
    "corr_frame",
    f"""SELECT category, COUNT(*) AS n, ROUND(CORR(distance_km, trip_fare), 8) AS corr_distance_fare, ROUND(REGR_SLOPE(trip_fare, distance_km), 4) AS slope_distance_fare,
        ROUND(REGR_INTERCEPT(trip_fare, distance_km), 2) AS intercept_distance_fare FROM ({_REG}) GROUP BY 1""",
)
def _(t):
    df = stats.correlations(regression_frame(t), [("distance_km", "trip_fare")], ["category"])
    return df.select(
        "category", "n", F.round("corr_distance_km_trip_fare", 8).alias("corr_distance_fare"), F.round("slope_distance_km_trip_fare", 4).alias("slope_distance_fare"),
        F.round("intercept_distance_km_trip_fare", 2).alias("intercept_distance_fare"),
    )


@query("corr_safety", "SELECT COUNT(*) AS n, ROUND(CORR(harsh_brakes, rating), 8) AS corr_brakes_rating FROM telematics")
def _(t):
    df = stats.correlations(t["telematics"], [("harsh_brakes", "rating")])
    return df.select("n", F.round("corr_harsh_brakes_rating", 8).alias("corr_brakes_rating"))


@query(
    "feat_safety",
    """SELECT telem_id, harsh_brakes::DOUBLE AS harsh_brakes, harsh_accels::DOUBLE AS harsh_accels, idle_minutes::DOUBLE AS idle_minutes, speeding_km, profile FROM telematics JOIN telem_drivers USING (driver_id)""",
)
def _(t):
    return features.safety(t["telematics"], t["telem_drivers"])


@query(
    "feat_demand",
    """SELECT CAST(day AS VARCHAR) AS day, city, trip_count, CAST(EXTRACT(isodow FROM day) - 1 AS INTEGER) AS dow, CAST(EXTRACT(month FROM day) AS INTEGER) AS month, CAST(EXTRACT(year FROM day) AS INTEGER) AS year,
        CAST(EXTRACT(isodow FROM day) >= 6 AS INTEGER) AS is_weekend, CAST(EXTRACT(day FROM day) AS INTEGER) AS day_of_month FROM (SELECT CAST(pickup_datetime AS DATE) AS day, pickup_city AS city, COUNT(*) AS trip_count FROM city_trips GROUP BY 1, 2)""",
)
def _(t):
    return features.demand(t["city_trips"], "pickup_datetime", "pickup_city")


def maintenance_frame(t):
    staged = materialise(t["staged_maintenance"].select("maint_id", "vehicle_id", "maintenance_date", "maintenance_type"), "staged-maintenance")
    return features.maintenance(staged, t["vehicles"], 2001)


@query(
    "feat_maint",
    """SELECT maint_id, vehicle_id, 2001 - year AS vehicle_age, odometer_km, COALESCE(DATE_DIFF('day', LAG(maintenance_date) OVER w, maintenance_date), 90) AS days_since_last, maintenance_type,
        COALESCE(CAST(DATE_DIFF('day', maintenance_date, LEAD(maintenance_date) OVER w) < 14 AS INTEGER), 0) AS upcoming FROM staged_maintenance LEFT JOIN vehicles USING (vehicle_id)
        WINDOW w AS (PARTITION BY vehicle_id ORDER BY maintenance_date, maint_id)""",
)
def _(t):
    return maintenance_frame(t)


def pricing_frame(t):
    staged = t["staged_trips"]
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("booking_type"))
    s = t["supplier"].select(F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").alias("n_nationkey"))
    cities = s.join(t["nation"], "n_nationkey").select("driver_id", F.col("n_name").alias("pickup_city"))
    return features.pricing(staged.join(o, "l_orderkey").join(cities, "driver_id"), "pickup_datetime")


@query(
    "feat_pricing",
    f"""SELECT trip_id, CAST(EXTRACT(month FROM pickup_datetime) AS INTEGER) AS month, CAST(EXTRACT(isodow FROM pickup_datetime) - 1 AS INTEGER) AS dow, CAST(EXTRACT(isodow FROM pickup_datetime) >= 6 AS INTEGER) AS is_weekend,
        n_name AS city, o_orderpriority AS booking_type, distance_km, trip_fare / GREATEST(duration_days, 0.1) AS fare_per_day FROM staged_trips JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON driver_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE {DONE}""",
)
def _(t):
    return pricing_frame(t)


_SPLITS = {"safety": ("feat_safety", "telem_id", "profile"), "demand": ("feat_demand", "day || '|' || city", "'all'"), "maintenance": ("feat_maint", "maint_id", "upcoming"), "pricing": ("feat_pricing", "trip_id", "'all'")}


def _splits_sql():
    parts = []
    for model, (frame, key, label) in _SPLITS.items():
        bucket = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 1000"
        parts.append(f"SELECT '{model}' AS model, CASE WHEN {bucket} < {int(training.TEST_SHARES[model] * 1000)} THEN 'test' ELSE 'train' END AS part, CAST({label} AS VARCHAR) AS label, COUNT(*) AS n FROM ({ORACLES[frame]}) GROUP BY 1, 2, 3")
    return " UNION ALL ".join(parts)


@query("model_splits", _splits_sql())
def _(t):
    """What each model learns from and is tested on: rows per part and label."""
    frames = {
        "safety": (features.safety(t["telematics"], t["telem_drivers"]), "telem_id", F.col("profile")), "demand": (features.demand(t["city_trips"], "pickup_datetime", "pickup_city"), F.concat_ws("|", "day", "city"), F.lit("all")),
        "maintenance": (maintenance_frame(t), "maint_id", F.col("upcoming")), "pricing": (pricing_frame(t), "trip_id", F.lit("all")),
    }
    out = []
    for model, (df, key, label) in frames.items():
        part = F.when(features.in_test(key, training.TEST_SHARES[model]), "test").otherwise("train")
        out.append(df.groupBy(F.lit(model).alias("model"), part.alias("part"), label.cast("string").alias("label")).agg(rows().alias("n")))
    return union_all(*out)


@query("driver_safety_model")
def _(t):
    _, scored = safety_model(t)
    return scored.groupBy("profile", "predicted_profile").agg(rows().alias("n"))


@query("demand_model")
def _(t):
    frame = features.demand(t["city_trips"], "pickup_datetime", "pickup_city")
    model, _ = fitted(t, "demand", lambda: training.train_demand(frame))
    cities = t["nation"].select(F.col("n_name").alias("city"))
    return training.forecast_demand(model, cities, AS_OF)


@query("revenue_forecast")
def _(t):
    return forecast.revenue_forecast(t["fleet_invoices"], "fleet_id", "invoice_date", "total_amount")


@query("maintenance_model")
def _(t):
    _, scored = fitted(t, "maintenance", lambda: training.train_maintenance(maintenance_frame(t)))
    risky = training.at_risk(scored)
    return risky.groupBy("vehicle_id").agg(F.max("risk").alias("risk"), rows().alias("services"))


@query("pricing_model")
def _(t):
    _, scored = pricing_model(t)
    return training.regression_report(scored)


@query("price_surface")
def _(t):
    model, _ = pricing_model(t)
    return training.price_surface(model, t["nation"].select(F.col("n_name").alias("city")), "1-URGENT", 250.0)


@query("model_report")
def _(t):
    _, scored = safety_model(t)
    return training.classification_report(scored)


@query("feature_importance")
def _(t):
    model, scored = safety_model(t)
    return training.feature_importance(scored, model, training.SAFETY_FEATURES, 2)
