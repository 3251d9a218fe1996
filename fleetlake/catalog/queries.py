"""The catalogue of named analytical queries on the sample tables."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF
from fleetlake.catalog.registry import A, CI, D, M, P, R, S, SI, TS, query
from fleetlake.constants import DOWNTIME_BEYOND, DOWNTIME_CATEGORIES, IDLE_FUEL_PRICE, IDLE_LITRES_PER_HOUR, RISK_BEYOND, RISK_CATEGORIES, RISK_WEIGHTS
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import count_if, davg, dsum, pct, ratio, rows, sum_if, zero, zero_int
from fleetlake.operators import joins, scale, windows
from fleetlake.operators.aggregates import distinct_list, grid, pivot_sum, share_of_total
from fleetlake.operators.sets import sample_rows, union_all
from fleetlake.plans import customers, finance
from fleetlake.session import materialise

DONE = "status = 'Completed'"


def done():
    return F.col("status") == "Completed"


def cancelled():
    return F.col("status") == "Cancelled"


def as_of():
    return F.lit(AS_OF).cast("date")


_MONTHLY = f"""(SELECT {M('invoice_date')} AS month, COUNT(*) AS invoice_count, {S('total_amount')} AS total_billed, {S('paid_amount')} AS total_collected,
    {S('outstanding')} AS outstanding FROM invoices GROUP BY 1)"""


@query(
    "q01_monthly_mom",
    f"""SELECT {D('month')} AS month, invoice_count, total_billed, total_collected, outstanding,
        {P('total_billed - LAG(total_billed) OVER w', 'LAG(total_billed) OVER w')} AS mom_growth_pct,
        CAST(SUM(CAST(total_billed AS DECIMAL(18,4))) OVER w AS DOUBLE) AS cumulative_revenue FROM {_MONTHLY} WINDOW w AS (ORDER BY month) ORDER BY month""",
)
def _(t):
    m = finance.with_month_growth(finance.monthly_billing(t["invoices"]), "total_billed")
    run = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumns(
        {
            "mom_growth_pct": pct(F.col("total_billed") - F.col("prev"), "prev"),
            "cumulative_revenue": F.sum(fn.wide_money("total_billed")).over(run).cast("double"),
        }
    ).drop("prev").orderBy("month")


@query(
    "q02_fleet_rank_share",
    f"""SELECT fleet_name, total_revenue, collected, avg_invoice, invoice_count, RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank,
        DENSE_RANK() OVER (ORDER BY total_revenue DESC) AS dense_pos, {P('total_revenue', "CAST(SUM(CAST(total_revenue AS DECIMAL(18,4))) OVER () AS DOUBLE)")} AS revenue_share_pct
        FROM (SELECT fleet_name, {S('total_amount')} AS total_revenue, {S('paid_amount')} AS collected, {A('total_amount')} AS avg_invoice, COUNT(*) AS invoice_count
            FROM fleet_invoices JOIN fleets USING (fleet_id) GROUP BY 1)""",
)
def _(t):
    per = t["fleet_invoices"].groupBy("fleet_id").agg(
        dsum("total_amount").alias("total_revenue"), dsum("paid_amount").alias("collected"),
        davg("total_amount").alias("avg_invoice"), rows().alias("invoice_count"),
    )
    df = materialise(per.join(t["fleets"], "fleet_id").drop("fleet_id"), "fleets")
    ranked = scale.ranks(df, [], "-total_revenue", rank="revenue_rank", dense="dense_pos")
    return share_of_total(ranked, "total_revenue", "revenue_share_pct")


@query(
    "q03_running_rolling",
    f"""SELECT {D('month')} AS month, total_billed AS monthly_rev, CAST(SUM(CAST(total_billed AS DECIMAL(18,4))) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
        CAST(SUM(CAST(total_billed AS DECIMAL(18,4))) OVER w3 AS DOUBLE) / COUNT(*) OVER w3 AS rolling_3m_avg,
        MAX(total_billed) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_6m_peak FROM {_MONTHLY}
        WINDOW w3 AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    w = Window.orderBy("month")
    run, last3 = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(-2, 0)
    m, c = finance.monthly_billing(t["invoices"]), fn.wide_money("total_billed")
    return m.select(
        "month",
        F.col("total_billed").alias("monthly_rev"),
        F.sum(c).over(run).cast("double").alias("running_total"),
        (F.sum(c).over(last3).cast("double") / rows().over(last3)).alias("rolling_3m_avg"),
        F.max("total_billed").over(w.rowsBetween(-5, 0)).alias("rolling_6m_peak"),
    )


@query(
    "q04_value_buckets",
    """SELECT invoice_id, customer_id, total_amount, NTILE(4) OVER (ORDER BY total_amount, invoice_id) AS quartile,
        NTILE(10) OVER (ORDER BY total_amount, invoice_id) AS decile, PERCENT_RANK() OVER (ORDER BY total_amount) AS pr, CUME_DIST() OVER (ORDER BY total_amount) AS cd
        FROM invoices WHERE payment_status = 'Paid' ORDER BY total_amount DESC, invoice_id LIMIT 100""",
)
def _(t):
    paid = t["invoices"].where(F.col("payment_status") == "Paid").select("invoice_id", "customer_id", "total_amount")
    df = scale.ntile(paid, [], ["total_amount", "invoice_id"], {"quartile": 4, "decile": 10})
    df = scale.ranks(df, [], "total_amount", percent="pr", cume="cd")
    return df.orderBy(F.desc("total_amount"), "invoice_id").limit(100)


@query(
    "q05_method_share",
    f"""WITH m AS (SELECT payment_method, COUNT(*) AS invoice_count, {S('total_amount')} AS total_billed, {S('paid_amount')} AS total_collected,
        {S('outstanding')} AS outstanding FROM invoices GROUP BY 1)
        SELECT *, {P('total_collected', 'total_billed')} AS collection_rate_pct, {P('total_billed', f"(SELECT {S('total_billed')} FROM m)")} AS share_of_total_pct FROM m""",
)
def _(t):
    return finance.method_share(t["invoices"])


def _ageing_sql(days):
    return f"""CASE WHEN {days} <= 0 THEN 'Current' WHEN {days} <= 30 THEN '1-30 Days' WHEN {days} <= 60 THEN '31-60 Days'
        WHEN {days} <= 90 THEN '61-90 Days' ELSE '90+ Days' END"""


_OVERDUE = f"DATE_DIFF('day', due_date, DATE '{AS_OF}')"


@query(
    "q06_ar_aging",
    f"SELECT {_ageing_sql(_OVERDUE)} AS aging_bucket, COUNT(*) AS invoices, {S('outstanding')} AS outstanding, {A('outstanding')} AS avg_outstanding FROM invoices WHERE outstanding > 0 GROUP BY 1",
)
def _(t):
    owed = t["invoices"].where(F.col("outstanding") > 0)
    g = owed.groupBy(finance.ageing_bucket("due_date", AS_OF).alias("aging_bucket")).agg(
        rows().alias("invoices"), dsum("outstanding").alias("outstanding"), davg("outstanding").alias("avg_outstanding")
    )
    order = F.array_position(F.array(*[F.lit(x) for x in finance.AGEING[1]]), F.col("aging_bucket"))
    return g.orderBy(order)


_YEARS = list(range(1995, 2002))
_YEAR_LIST = ", ".join(map(str, _YEARS))


@query(
    "q07_yoy_pivot",
    "SELECT EXTRACT(month FROM invoice_date) AS month_num, STRFTIME(invoice_date, '%b') AS month_name, "
    + ", ".join(f"{SI(f'EXTRACT(year FROM invoice_date) = {y}', 'total_amount')} AS rev_{y}" for y in _YEARS)
    + f", {SI(f'EXTRACT(year FROM invoice_date) NOT IN ({_YEAR_LIST})', 'total_amount')} AS rev_other FROM invoices GROUP BY 1, 2",
)
def _(t):
    df = t["invoices"].withColumns(
        {"month_num": F.month("invoice_date").cast("bigint"), "month_name": F.date_format("invoice_date", "MMM")}
    )
    return pivot_sum(df, ["month_num", "month_name"], F.year("invoice_date"), _YEARS, F.col("total_amount"), "rev_", other="rev_other")


_PROBS = {"p25": 0.25, "p50_median": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}


@query(
    "q08_percentiles",
    f"SELECT booking_type, COUNT(*) AS trip_count, {A('duration_days')} AS avg_duration_days, "
    + ", ".join(f"ROUND(QUANTILE_CONT(duration_days, {p}), 4) AS {n}" for n, p in _PROBS.items())
    + f", {A('distance_km')} AS avg_km, {A('trip_fare')} AS avg_fare FROM booked_trips WHERE {DONE} GROUP BY 1",
)
def _(t):
    # the join is read by the means and by the percentiles: written once
    trips = materialise(t["booked_trips"].where(done()).select("booking_type", "duration_days", "distance_km", "trip_fare"), "booked-trips")
    means = trips.groupBy("booking_type").agg(
        rows().alias("trip_count"), davg("duration_days").alias("avg_duration_days"), davg("distance_km").alias("avg_km"), davg("trip_fare").alias("avg_fare")
    )
    q = scale.percentiles(trips, ["booking_type"], "duration_days", _PROBS)
    q = q.select("booking_type", *[F.round(n, 4).alias(n) for n in _PROBS])
    return means.join(q, "booking_type")


@query(
    "q09_hour_dow",
    f"""SELECT DAYNAME(trip_date) AS day_of_week, EXTRACT(hour FROM trip_date) AS hour_of_day, COUNT(*) AS trip_count, {A('speeding_km')} AS avg_value,
        {S('speeding_km')} AS total_value FROM telematics GROUP BY 1, 2""",
)
def _(t):
    d = F.col("trip_date")
    g = t["telematics"].groupBy(
        F.weekday(d).alias("_wd"), F.date_format(d, "EEEE").alias("day_of_week"), F.hour(d).cast("bigint").alias("hour_of_day")
    ).agg(rows().alias("trip_count"), davg("speeding_km").alias("avg_value"), dsum("speeding_km").alias("total_value"))
    return g.orderBy("_wd", "hour_of_day").drop("_wd")


def route_stats(trips):
    return trips.groupBy("pickup_city", "dropoff_city").agg(
        rows().alias("trip_count"), dsum("trip_fare").alias("total_revenue"), davg("trip_fare").alias("avg_fare"),
        davg("distance_km").alias("avg_km"), davg("duration_days").alias("avg_duration"),
    )


@query(
    "q10_top_routes",
    f"""SELECT pickup_city || ' → ' || dropoff_city AS route, trip_count, total_revenue, avg_fare, avg_km, avg_duration,
        RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank, RANK() OVER (ORDER BY trip_count DESC) AS volume_rank FROM (
        SELECT pickup_city, dropoff_city, COUNT(*) AS trip_count, {S('trip_fare')} AS total_revenue, {A('trip_fare')} AS avg_fare, {A('distance_km')} AS avg_km,
            {A('duration_days')} AS avg_duration FROM routed_trips WHERE {DONE} AND pickup_city <> dropoff_city GROUP BY 1, 2) ORDER BY total_revenue DESC, route LIMIT 20""",
)
def _(t):
    r = route_stats(t["routed_trips"].where(done() & (F.col("pickup_city") != F.col("dropoff_city"))))
    r = r.withColumn("route", F.concat_ws(" → ", "pickup_city", "dropoff_city")).drop("pickup_city", "dropoff_city")
    r = materialise(r, "routes")
    r = scale.ranks(r, [], "-total_revenue", rank="revenue_rank")
    return scale.ranks(r, [], "-trip_count", rank="volume_rank").orderBy(F.desc("total_revenue"), "route").limit(20)


@query(
    "q11_cancel_rate",
    f"""SELECT pickup_city, {D('month')} AS month, total_trips, cancellations, {P('cancellations', 'total_trips')} AS cancellation_rate_pct FROM (
        SELECT pickup_city, {M('pickup_datetime')} AS month, COUNT(*) AS total_trips, {CI("status = 'Cancelled'")} AS cancellations FROM city_trips GROUP BY 1, 2)
        WHERE total_trips >= 10 ORDER BY cancellation_rate_pct DESC, month, pickup_city LIMIT 30""",
)
def _(t):
    g = t["city_trips"].groupBy("pickup_city", fn.month_start("pickup_datetime").alias("month")).agg(
        rows().alias("total_trips"), count_if(cancelled()).alias("cancellations")
    )
    g = g.where(F.col("total_trips") >= 10).withColumn("cancellation_rate_pct", pct("cancellations", "total_trips"))
    return g.orderBy(F.desc("cancellation_rate_pct"), "month", "pickup_city").limit(30)


@query(
    "q12_booking_gaps",
    f"""SELECT customer_id, invoice_id, {D('invoice_date')} AS booked, {D('prev')} AS prev_trip, DATE_DIFF('day', prev, invoice_date) AS days_since_last,
        DATE_DIFF('day', invoice_date, nxt) AS days_to_next FROM (SELECT customer_id, invoice_id, invoice_date, LAG(invoice_date) OVER w AS prev, LEAD(invoice_date) OVER w AS nxt
        FROM invoices WINDOW w AS (PARTITION BY customer_id ORDER BY invoice_date, invoice_id)) WHERE prev IS NOT NULL ORDER BY days_since_last DESC, invoice_id LIMIT 50""",
)
def _(t):
    i = t["invoices"].select("customer_id", "invoice_id", "invoice_date")
    df = scale.bounded(
        i, ["customer_id"], ["invoice_date", "invoice_id"],
        {"prev": lambda w: F.lag("invoice_date").over(w), "nxt": lambda w: F.lead("invoice_date").over(w)}, before=1, after=1,
    )
    out = df.where(F.col("prev").isNotNull()).select(
        "customer_id", "invoice_id", F.col("invoice_date").alias("booked"), F.col("prev").alias("prev_trip"),
        fn.days_between("prev", "invoice_date").alias("days_since_last"), fn.days_between("invoice_date", "nxt").alias("days_to_next"),
    )
    return out.orderBy(F.desc("days_since_last"), "invoice_id").limit(50)


@query(
    "q13_first_last",
    f"""SELECT customer_id, {D('MIN(invoice_date)')} AS first_trip_date, {D('MAX(invoice_date)')} AS last_trip_date, COUNT(*) AS total_trips,
        DATE_DIFF('day', MIN(invoice_date), MAX(invoice_date)) AS lifespan_days FROM invoices GROUP BY 1 ORDER BY total_trips DESC, customer_id LIMIT 50""",
)
def _(t):
    g = t["invoices"].groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_trip_date"), F.max("invoice_date").alias("last_trip_date"), rows().alias("total_trips")
    )
    g = g.withColumn("lifespan_days", fn.days_between("first_trip_date", "last_trip_date"))
    return g.orderBy(F.desc("total_trips"), "customer_id").limit(50)


@query(
    "q14_seasonality",
    """WITH m AS (SELECT payment_method AS booking_type, EXTRACT(month FROM invoice_date) AS month_num, COUNT(*) AS trip_count FROM invoices GROUP BY 1, 2)
        SELECT m.*, trip_count / avg_monthly AS seasonality_index FROM m JOIN (SELECT booking_type, AVG(trip_count) AS avg_monthly FROM m GROUP BY 1) USING (booking_type)""",
)
def _(t):
    m = t["invoices"].groupBy(F.col("payment_method").alias("booking_type"), F.month("invoice_date").cast("bigint").alias("month_num")).agg(rows().alias("trip_count"))
    mean = F.avg("trip_count").over(Window.partitionBy("booking_type"))  # at most 12 rows per type
    return m.withColumn("seasonality_index", ratio("trip_count", mean))


@query(
    "q15_score_trend",
    f"""SELECT x.driver_id, profile, telem_id, {TS('trip_date')} AS trip_date, safety_score, rolling_avg, prev_score,
        CASE WHEN safety_score > prev_score THEN 'Improving' WHEN safety_score < prev_score THEN 'Declining' ELSE 'Stable' END AS trend FROM (
        SELECT *, CAST(SUM(CAST(safety_score AS DECIMAL(18,4))) OVER r AS DOUBLE) / COUNT(*) OVER r AS rolling_avg, LAG(safety_score) OVER (PARTITION BY driver_id ORDER BY trip_date, telem_id) AS prev_score
        FROM telematics WINDOW r AS (PARTITION BY driver_id ORDER BY trip_date, telem_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) x
        JOIN telem_drivers d ON x.driver_id = d.driver_id ORDER BY x.driver_id, trip_date, telem_id LIMIT 200""",
)
def _(t):
    tel = t["telematics"].select("driver_id", "telem_id", "trip_date", "safety_score")
    score = fn.money("safety_score")
    df = scale.bounded(
        tel, ["driver_id"], ["trip_date", "telem_id"],
        {
            "rolling_avg": lambda w: F.sum(score).over(w.rowsBetween(-4, 0)).cast("double") / rows().over(w.rowsBetween(-4, 0)),
            "prev_score": lambda w: F.lag("safety_score").over(w),
        },
        before=4,
    )
    trend = F.when(F.col("safety_score") > F.col("prev_score"), "Improving").when(F.col("safety_score") < F.col("prev_score"), "Declining").otherwise("Stable")
    df = df.withColumn("trend", trend).join(t["telem_drivers"], "driver_id")
    return df.orderBy("driver_id", "trip_date", "telem_id").limit(200)


def driver_kpis(tel):
    return tel.groupBy("driver_id").agg(
        rows().alias("total_trips"), davg("safety_score").alias("avg_safety"), F.sum("harsh_brakes").alias("total_harsh_brakes"),
        F.sum("harsh_accels").alias("total_harsh_accels"), F.avg("idle_minutes").alias("avg_idle_min"), dsum("speeding_km").alias("total_speeding_km"),
        count_if(F.col("accident")).alias("accidents"), count_if(F.col("complaint")).alias("complaints"), F.avg("rating").alias("avg_rating"),
    )


_DRIVER_KPIS = f"""(SELECT driver_id, COUNT(*) AS total_trips, {A('safety_score')} AS avg_safety, CAST(SUM(harsh_brakes) AS BIGINT) AS total_harsh_brakes,
    CAST(SUM(harsh_accels) AS BIGINT) AS total_harsh_accels, AVG(idle_minutes) AS avg_idle_min, {S('speeding_km')} AS total_speeding_km,
    {CI('accident')} AS accidents, {CI('complaint')} AS complaints, AVG(rating) AS avg_rating FROM telematics GROUP BY 1)"""


@query(
    "q16_risk_score",
    f"""SELECT s.*, profile, RANK() OVER (ORDER BY composite_risk_score DESC) AS risk_rank, CASE WHEN composite_risk_score < 20 THEN 'Low Risk'
        WHEN composite_risk_score < 45 THEN 'Medium Risk' WHEN composite_risk_score < 70 THEN 'High Risk' ELSE 'Critical' END AS risk_category FROM (
        SELECT *, ROUND(((100 - avg_safety) * 0.35::DOUBLE + CAST(total_harsh_brakes AS DOUBLE) / total_trips * 15 + CAST(total_harsh_accels AS DOUBLE) / total_trips * 10
            + avg_idle_min * 0.05::DOUBLE + total_speeding_km / total_trips * 0.1::DOUBLE + accidents * 8 + complaints * 3), 2) AS composite_risk_score FROM {_DRIVER_KPIS}) s
        JOIN telem_drivers USING (driver_id)""",
)
def _(t):
    k = driver_kpis(t["telematics"])
    parts = {
        "lost safety": 100 - F.col("avg_safety"), "brakes per trip": ratio("total_harsh_brakes", "total_trips"), "accelerations per trip": ratio("total_harsh_accels", "total_trips"),
        "mean idle minutes": F.col("avg_idle_min"), "speeding km per trip": ratio("total_speeding_km", "total_trips"), "accidents": F.col("accidents"), "complaints": F.col("complaints"),
    }
    score = reduce(add, [part * RISK_WEIGHTS[name] for name, part in parts.items()])
    df = materialise(k.withColumn("composite_risk_score", F.round(score, 2)).join(t["telem_drivers"], "driver_id"), "risk")
    category = fn.below("composite_risk_score", RISK_CATEGORIES, RISK_BEYOND)
    return scale.ranks(df, [], "-composite_risk_score", rank="risk_rank").withColumn("risk_category", category)


@query(
    "q17_idle_vs_fuel",
    f"""SELECT driver_id, profile, total_idle_min, avg_idle_per_trip, total_fuel_cost, avg_efficiency, total_idle_min / 60.0::DOUBLE * 0.5::DOUBLE * 260 AS est_idle_fuel_cost,
        total_idle_min / 60.0::DOUBLE * 0.5::DOUBLE * 260 / NULLIF(total_fuel_cost, 0) * 100 AS idle_pct_of_fuel FROM (
        SELECT driver_id, CAST(SUM(idle_minutes) AS BIGINT) AS total_idle_min, AVG(idle_minutes) AS avg_idle_per_trip FROM telematics GROUP BY 1) JOIN telem_drivers USING (driver_id)
        LEFT JOIN (SELECT driver_id, {S('fuel_cost')} AS total_fuel_cost, {A('efficiency')} AS avg_efficiency FROM fuel_logs GROUP BY 1) USING (driver_id)
        ORDER BY total_idle_min DESC, driver_id LIMIT 30""",
)
def _(t):
    idle = t["telematics"].groupBy("driver_id").agg(F.sum("idle_minutes").alias("total_idle_min"), F.avg("idle_minutes").alias("avg_idle_per_trip"))
    fuel = t["fuel_logs"].groupBy("driver_id").agg(dsum("fuel_cost").alias("total_fuel_cost"), davg("efficiency").alias("avg_efficiency"))
    est = F.col("total_idle_min") / 60.0 * IDLE_LITRES_PER_HOUR * IDLE_FUEL_PRICE
    df = joins.preaggregated(idle.join(t["telem_drivers"], "driver_id"), "driver_id", [fuel])
    df = df.withColumns({"est_idle_fuel_cost": est, "idle_pct_of_fuel": F.try_divide(est, "total_fuel_cost") * 100})
    return df.orderBy(F.desc("total_idle_min"), "driver_id").limit(30)


@query(
    "q18_recurrence",
    f"""SELECT driver_id, profile, total_trips, cumulative_accidents, {P('cumulative_accidents', 'total_trips')} AS accident_rate_pct FROM (
        SELECT driver_id, trip_date, telem_id, CAST(SUM(CAST(accident AS INTEGER)) OVER (PARTITION BY driver_id ORDER BY trip_date, telem_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_accidents,
        COUNT(*) OVER (PARTITION BY driver_id) AS total_trips FROM telematics) JOIN telem_drivers USING (driver_id) WHERE cumulative_accidents > 0
        QUALIFY ROW_NUMBER() OVER (PARTITION BY driver_id ORDER BY trip_date DESC, telem_id DESC) = 1""",
)
def _(t):
    # the last row of a running count is the total, so one aggregate replaces both windows
    g = t["telematics"].groupBy("driver_id").agg(rows().alias("total_trips"), count_if(F.col("accident")).alias("cumulative_accidents"))
    g = g.where(F.col("cumulative_accidents") > 0).withColumn("accident_rate_pct", pct("cumulative_accidents", "total_trips"))
    return g.join(t["telem_drivers"], "driver_id")


@query(
    "q19_rating_rank",
    """SELECT driver_id, profile, rated_trips, avg_rating, min_rating, max_rating, consistency, RANK() OVER (ORDER BY avg_rating DESC) AS rating_rank,
        PERCENT_RANK() OVER (ORDER BY avg_rating) AS rating_percentile FROM (SELECT driver_id, COUNT(*) AS rated_trips, AVG(rating) AS avg_rating, MIN(rating) AS min_rating,
        MAX(rating) AS max_rating, ROUND(STDDEV_SAMP(rating), 6) AS consistency FROM telematics GROUP BY 1 HAVING COUNT(*) >= 5) JOIN telem_drivers USING (driver_id)
        ORDER BY avg_rating DESC, driver_id LIMIT 20""",
)
def _(t):
    g = t["telematics"].groupBy("driver_id").agg(
        rows().alias("rated_trips"), F.avg("rating").alias("avg_rating"), F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"), F.round(F.stddev_samp("rating"), 6).alias("consistency"),
    )
    df = materialise(g.where(F.col("rated_trips") >= 5).join(t["telem_drivers"], "driver_id"), "ratings")
    df = scale.ranks(df, [], "-avg_rating", rank="rating_rank")
    df = scale.ranks(df, [], "avg_rating", percent="rating_percentile")
    return df.orderBy(F.desc("avg_rating"), "driver_id").limit(20)


_USAGE = f"(SELECT vehicle_id, {M('pickup_datetime')} AS month, {S('duration_days')} AS days_in_use FROM trips WHERE {DONE} GROUP BY 1, 2)"


def vehicle_months(trips):
    return trips.where(done()).groupBy("vehicle_id", fn.month_start("pickup_datetime").alias("month")).agg(dsum("duration_days").alias("days_in_use"))


@query(
    "q20_utilisation",
    f"""SELECT vehicle_id, make, model, year, {D('month')} AS month, days_in_use, days_in_use / 30 * 100 AS utilisation_pct,
        CAST(SUM(CAST(days_in_use AS DECIMAL(18,4))) OVER (PARTITION BY vehicle_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY vehicle_id) / 30 * 100 AS avg_util_pct
        FROM {_USAGE} JOIN vehicles USING (vehicle_id) ORDER BY month DESC, utilisation_pct DESC, vehicle_id LIMIT 100""",
)
def _(t, days_basis=30):
    m = vehicle_months(t["trips"])
    w = Window.partitionBy("vehicle_id")  # one row per month
    df = m.withColumns(
        {
            "utilisation_pct": F.col("days_in_use") / days_basis * 100,
            "avg_util_pct": F.sum(fn.money("days_in_use")).over(w).cast("double") / rows().over(w) / days_basis * 100,
        }
    )
    v = t["vehicles"].select("vehicle_id", "make", "model", "year")
    return df.join(v, "vehicle_id").orderBy(F.desc("month"), F.desc("utilisation_pct"), "vehicle_id").limit(100)


@query(
    "q21_rev_per_km",
    f"""SELECT vehicle_id, make, model, year, category, total_revenue, total_km, trip_count, total_revenue / NULLIF(total_km, 0) AS revenue_per_km,
        RANK() OVER (PARTITION BY category ORDER BY total_revenue / NULLIF(total_km, 0) DESC) AS rank_in_category FROM (SELECT vehicle_id, {S('trip_fare')} AS total_revenue,
        {S('distance_km')} AS total_km, COUNT(*) AS trip_count FROM trips WHERE {DONE} GROUP BY 1) JOIN vehicles USING (vehicle_id) ORDER BY revenue_per_km DESC, vehicle_id LIMIT 40""",
)
def _(t):
    g = t["trips"].where(done()).groupBy("vehicle_id").agg(dsum("trip_fare").alias("total_revenue"), dsum("distance_km").alias("total_km"), rows().alias("trip_count"))
    df = g.withColumn("revenue_per_km", ratio("total_revenue", "total_km")).join(t["vehicles"].select("vehicle_id", "make", "model", "year", "category"), "vehicle_id")
    df = materialise(df, "revenue-per-km")
    return scale.ranks(df, ["category"], "-revenue_per_km", rank="rank_in_category").orderBy(F.desc("revenue_per_km"), "vehicle_id").limit(40)


@query(
    "q22_cum_maint",
    f"""SELECT vehicle_id, make, model, maint_id, {D('maintenance_date')} AS maintenance_date, maintenance_type, total_cost,
        CAST(SUM(CAST(total_cost AS DECIMAL(18,4))) OVER (PARTITION BY vehicle_id ORDER BY maintenance_date, maint_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_cost,
        CAST(SUM(CAST(total_cost AS DECIMAL(18,4))) OVER (PARTITION BY vehicle_id) AS DOUBLE) / COUNT(*) OVER (PARTITION BY vehicle_id) AS avg_maint_cost
        FROM staged_maintenance JOIN vehicles USING (vehicle_id) ORDER BY vehicle_id, maintenance_date, maint_id LIMIT 200""",
)
def _(t):
    m = t["staged_maintenance"].select("vehicle_id", "maint_id", "maintenance_date", "maintenance_type", "total_cost")
    m = materialise(m, "staged-maintenance")
    run = scale.running(m, ["vehicle_id"], ["maintenance_date", "maint_id"], {"_c": fn.money("total_cost")})
    mean = m.groupBy("vehicle_id").agg(davg("total_cost").alias("avg_maint_cost"))
    dims = t["vehicles"].select("vehicle_id", "make", "model").join(mean, "vehicle_id")
    out = run.join(dims, "vehicle_id").withColumn("cumulative_cost", F.col("_c").cast("double")).drop("_c")
    return out.orderBy("vehicle_id", "maintenance_date", "maint_id").limit(200)


_SINCE = f"DATE_DIFF('day', last_maint_date, DATE '{AS_OF}')"


@query(
    "q23_service_overdue",
    f"""SELECT vehicle_id, make, model, year, odometer_km, status, {D('last_maint_date')} AS last_maint_date, {_SINCE} AS days_since_last_service, total_services, lifetime_maint_cost,
        CASE WHEN {_SINCE} > 180 THEN 'Overdue' WHEN {_SINCE} > 90 THEN 'Due Soon' ELSE 'OK' END AS service_status FROM vehicles LEFT JOIN (SELECT vehicle_id,
        MAX(maintenance_date) AS last_maint_date, COUNT(*) AS total_services, {S('total_cost')} AS lifetime_maint_cost FROM maintenance WHERE status = 'Completed' AND maintenance_date <= DATE '{AS_OF}' GROUP BY 1) USING (vehicle_id)
        ORDER BY days_since_last_service DESC NULLS FIRST, vehicle_id LIMIT 50""",
)
def _(t):
    past = t["maintenance"].where(done() & (F.col("maintenance_date") <= as_of()))
    last = past.groupBy("vehicle_id").agg(F.max("maintenance_date").alias("last_maint_date"), rows().alias("total_services"), dsum("total_cost").alias("lifetime_maint_cost"))
    v = t["vehicles"].select("vehicle_id", "make", "model", "year", "odometer_km", "status")
    days = fn.days_between("last_maint_date", as_of())
    df = v.join(last, "vehicle_id", "left").withColumn("days_since_last_service", days)
    df = df.withColumn("service_status", F.when(days > 180, "Overdue").when(days > 90, "Due Soon").otherwise("OK"))
    return df.orderBy(F.col("days_since_last_service").desc_nulls_first(), "vehicle_id").limit(50)


@query(
    "q24_age_profile",
    f"""SELECT vehicle_age, COUNT(*) AS vehicle_count, {A('total_maint_cost')} AS avg_maint_cost, AVG(odometer_km) AS avg_odometer, {S('total_maint_cost')} AS total_cost,
        AVG(service_count) AS avg_services FROM (SELECT v.vehicle_id, 2001 - year AS vehicle_age, odometer_km, m.total_maint_cost, COALESCE(m.service_count, 0) AS service_count
        FROM vehicles v LEFT JOIN (SELECT vehicle_id, {S('total_cost')} AS total_maint_cost, COUNT(*) AS service_count FROM maintenance GROUP BY 1) m ON v.vehicle_id = m.vehicle_id) GROUP BY 1""",
)
def _(t):
    m = t["maintenance"].groupBy("vehicle_id").agg(dsum("total_cost").alias("cost"), rows().alias("services"))
    df = t["vehicles"].join(m, "vehicle_id", "left")
    return df.groupBy((2001 - F.col("year")).alias("vehicle_age")).agg(
        rows().alias("vehicle_count"), davg("cost").alias("avg_maint_cost"), F.avg("odometer_km").alias("avg_odometer"),
        dsum("cost").alias("total_cost"), F.avg(zero_int("services")).alias("avg_services"),
    )


@query(
    "q25_fuel_zscore",
    """WITH s AS (SELECT vehicle_id, AVG(efficiency) AS mean_eff, STDDEV_SAMP(efficiency) AS std_eff FROM fuel_logs GROUP BY 1 HAVING COUNT(*) >= 3)
        SELECT f.vehicle_id, COUNT(*) AS anomalies, COUNT(CASE WHEN ABS((efficiency - mean_eff) / NULLIF(std_eff, 0)) > 3 THEN 1 END) AS severe,
        ROUND(MAX(ABS((efficiency - mean_eff) / NULLIF(std_eff, 0))), 4) AS worst_z FROM fuel_logs f JOIN s ON f.vehicle_id = s.vehicle_id
        WHERE ABS((efficiency - mean_eff) / NULLIF(std_eff, 0)) > 2 GROUP BY 1""",
)
def _(t):
    z = fuel_zscores(t).where(F.abs("z_score") > 2)
    return z.groupBy("vehicle_id").agg(
        rows().alias("anomalies"), count_if(F.abs("z_score") > 3).alias("severe"), F.round(F.max(F.abs("z_score")), 4).alias("worst_z")
    )


def fuel_zscores(t, min_rows=3):
    """Fuel logs with their z-score against the vehicle's own mean."""
    f = t["fuel_logs"]
    stats = f.groupBy("vehicle_id").agg(F.avg("efficiency").alias("mean_eff"), F.stddev_samp("efficiency").alias("std_eff"), rows().alias("_n"))
    df = f.join(stats.where(F.col("_n") >= min_rows).drop("_n"), "vehicle_id")
    return df.withColumn("z_score", F.try_divide(F.col("efficiency") - F.col("mean_eff"), F.col("std_eff")))


@query(
    "q25_fuel_zscore_top",
    """WITH s AS (SELECT vehicle_id, AVG(efficiency) AS mean_eff, STDDEV_SAMP(efficiency) AS std_eff FROM fuel_logs GROUP BY 1 HAVING COUNT(*) >= 3)
        SELECT fuel_id, f.vehicle_id, efficiency, fuel_type, ROUND((efficiency - mean_eff) / std_eff, 3) AS z_score,
        CASE WHEN ABS((efficiency - mean_eff) / std_eff) > 3 THEN 'Severe Anomaly' ELSE 'Anomaly' END AS anomaly_flag
        FROM fuel_logs f JOIN s ON f.vehicle_id = s.vehicle_id WHERE std_eff > 0 AND ABS((efficiency - mean_eff) / std_eff) > 2
        ORDER BY ABS((efficiency - mean_eff) / std_eff) DESC, fuel_id LIMIT 50""",
)
def _(t):
    z = fuel_zscores(t).where(F.abs("z_score") > 2)
    flag = F.when(F.abs("z_score") > 3, "Severe Anomaly").otherwise("Anomaly")
    return z.orderBy(F.abs("z_score").desc(), "fuel_id").limit(50).select(
        "fuel_id", "vehicle_id", "efficiency", "fuel_type", F.round("z_score", 3).alias("z_score"), flag.alias("anomaly_flag")
    )


@query(
    "q26_ltv",
    f"""SELECT cl.customer_id, total_invoices, total_spend, avg_order_value, total_paid, {D('first_purchase')} AS first_purchase, {D('last_purchase')} AS last_purchase, customer_age_days,
        full_name, customer_type, city, RANK() OVER (ORDER BY total_spend DESC) AS ltv_rank, NTILE(5) OVER (ORDER BY total_spend DESC, cl.customer_id) AS ltv_quintile,
        total_spend / NULLIF(customer_age_days, 0) * 365 AS annualised_spend FROM (SELECT customer_id, COUNT(DISTINCT invoice_id) AS total_invoices, {S('total_amount')} AS total_spend,
        {A('total_amount')} AS avg_order_value, {S('paid_amount')} AS total_paid, MIN(invoice_date) AS first_purchase, MAX(invoice_date) AS last_purchase,
        DATE_DIFF('day', MIN(invoice_date), MAX(invoice_date)) AS customer_age_days FROM invoices GROUP BY 1) cl JOIN customers c ON cl.customer_id = c.customer_id
        ORDER BY total_spend DESC, cl.customer_id LIMIT 30""",
)
def _(t):
    df = customers.lifetime_value(t["invoices"]).join(t["customers"], "customer_id")
    return df.orderBy(F.desc("total_spend"), "customer_id").limit(30)


@query(
    "q27_churn",
    f"""SELECT r.customer_id, full_name, customer_type, city, {D('last_trip')} AS last_trip, total_trips, days_inactive, CASE WHEN days_inactive <= 30 THEN 'Active'
        WHEN days_inactive <= 90 THEN 'At Risk' WHEN days_inactive <= 180 THEN 'Lapsing' ELSE 'Churned' END AS churn_segment, total_spend FROM (
        SELECT customer_id, MAX(invoice_date) AS last_trip, COUNT(*) AS total_trips, DATE_DIFF('day', MAX(invoice_date), DATE '{AS_OF}') AS days_inactive, {S('total_amount')} AS total_spend
        FROM invoices GROUP BY 1) r JOIN customers c ON r.customer_id = c.customer_id ORDER BY days_inactive DESC, r.customer_id LIMIT 50""",
)
def _(t):
    g = t["invoices"].groupBy("customer_id").agg(F.max("invoice_date").alias("last_trip"), rows().alias("total_trips"), dsum("total_amount").alias("total_spend"))
    g = g.withColumn("days_inactive", fn.days_between("last_trip", as_of())).withColumn("churn_segment", customers.churn_segment("days_inactive"))
    return g.join(t["customers"], "customer_id").orderBy(F.desc("days_inactive"), "customer_id").limit(50)


@query(
    "q28_rfm",
    f"""WITH raw AS (SELECT customer_id, DATE_DIFF('day', MAX(invoice_date), DATE '{AS_OF}') AS recency_days, COUNT(DISTINCT invoice_id) AS frequency, {S('total_amount')} AS monetary FROM invoices GROUP BY 1),
        s AS (SELECT *, NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score, NTILE(5) OVER (ORDER BY frequency, customer_id) AS f_score,
            NTILE(5) OVER (ORDER BY monetary, customer_id) AS m_score FROM raw)
        SELECT s.*, customer_type, r_score + f_score + m_score AS rfm_total, CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champion' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
            WHEN r_score >= 4 AND f_score < 2 THEN 'New Customer' WHEN r_score < 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score < 2 AND f_score < 2 THEN 'Lost' ELSE 'Potential' END AS rfm_segment
        FROM s JOIN customers USING (customer_id)""",
)
def _(t):
    raw = customers.rfm_raw(t["invoices"], "customer_id", "invoice_date", "invoice_id", "total_amount", AS_OF)
    return customers.rfm_scores(raw, "customer_id").join(t["customers"].select("customer_id", "customer_type"), "customer_id")


@query(
    "q29_pareto",
    f"""WITH r AS (SELECT customer_id, {S('total_amount')} AS total_revenue FROM invoices GROUP BY 1), g AS (SELECT {S('total_revenue')} AS total FROM r),
        x AS (SELECT customer_id, total_revenue, total, CAST(SUM(CAST(total_revenue AS DECIMAL(18,4))) OVER (ORDER BY total_revenue DESC, customer_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM r, g)
        SELECT customer_id, full_name, customer_type, total_revenue, running_total, running_total * 100.0::DOUBLE / total AS cumulative_pct,
        CASE WHEN running_total * 100.0::DOUBLE / total <= 80 THEN 'Top 80%' ELSE 'Tail 20%' END AS pareto_group FROM x JOIN customers USING (customer_id)
        ORDER BY total_revenue DESC, customer_id LIMIT 40""",
)
def _(t):
    r = t["invoices"].groupBy("customer_id").agg(dsum("total_amount").alias("total_revenue"))
    c = t["customers"].select("customer_id", "full_name", "customer_type")
    return windows.pareto(r, "total_revenue", "customer_id").join(c, "customer_id").orderBy(F.desc("total_revenue"), "customer_id").limit(40)


_DAILY_TRIPS = f"(SELECT CAST(pickup_datetime AS DATE) AS trip_date, COUNT(*) AS trip_count, {S('trip_fare')} AS daily_revenue FROM trips GROUP BY 1)"


@query(
    "q30_moving_avg",
    f"""SELECT {D('trip_date')} AS trip_date, trip_count, daily_revenue, AVG(trip_count) OVER w7 AS ma_7d_trips, AVG(trip_count) OVER w30 AS ma_30d_trips,
        CAST(SUM(CAST(daily_revenue AS DECIMAL(18,4))) OVER w7 AS DOUBLE) / COUNT(*) OVER w7 AS ma_7d_revenue, MAX(trip_count) OVER w30 AS peak_30d FROM {_DAILY_TRIPS}
        WINDOW w7 AS (ORDER BY trip_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), w30 AS (ORDER BY trip_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
        ORDER BY trip_date DESC LIMIT 100""",
)
def _(t):
    d = t["trips"].groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(rows().alias("trip_count"), dsum("trip_fare").alias("daily_revenue"))
    w = Window.orderBy("trip_date")  # one row per day
    w7, w30 = w.rowsBetween(-6, 0), w.rowsBetween(-29, 0)
    df = d.withColumns(
        {
            "ma_7d_trips": F.avg("trip_count").over(w7),
            "ma_30d_trips": F.avg("trip_count").over(w30),
            "ma_7d_revenue": F.sum(fn.wide_money("daily_revenue")).over(w7).cast("double") / rows().over(w7),
            "peak_30d": F.max("trip_count").over(w30),
        }
    )
    return df.orderBy(F.desc("trip_date")).limit(100)


@query(
    "q31_cohort",
    f"""WITH f AS (SELECT customer_id, {M('MIN(invoice_date)')} AS cohort_month FROM invoices GROUP BY 1)
        SELECT {D('cohort_month')} AS cohort_month, DATE_DIFF('month', cohort_month, invoice_date) AS months_since_first, COUNT(DISTINCT customer_id) AS active_customers
        FROM invoices JOIN f USING (customer_id) GROUP BY 1, 2""",
)
def _(t):
    return customers.cohorts(t["invoices"], "customer_id", "invoice_date")


@query(
    "q32_sessions",
    f"""SELECT customer_id, session_id, {D('MIN(invoice_date)')} AS session_start, {D('MAX(invoice_date)')} AS session_end, COUNT(*) AS trips_in_session,
        {S('total_amount')} AS session_revenue, DATE_DIFF('day', MIN(invoice_date), MAX(invoice_date)) AS session_span_days FROM (SELECT *, CAST(SUM(CASE WHEN gap IS NULL OR gap > 7 THEN 1 ELSE 0 END)
        OVER (PARTITION BY customer_id ORDER BY invoice_date, invoice_id) AS BIGINT) AS session_id FROM (SELECT *, DATE_DIFF('day', LAG(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date, invoice_id), invoice_date) AS gap FROM invoices))
        GROUP BY 1, 2""",
)
def _(t):
    i = t["invoices"].select("customer_id", "invoice_id", "invoice_date", "total_amount")
    s = windows.sessionize(i, ["customer_id"], "invoice_date", "invoice_id", gap_days=7)
    g = s.groupBy("customer_id", "session_id").agg(
        F.min("invoice_date").alias("session_start"), F.max("invoice_date").alias("session_end"), rows().alias("trips_in_session"), dsum("total_amount").alias("session_revenue")
    )
    return g.withColumn("session_span_days", fn.days_between("session_start", "session_end"))


@query(
    "q33_kpi_pivot",
    f"""SELECT {D(M('pickup_datetime'))} AS month, COUNT(*) AS total_trips, {CI(DONE)} AS completed, {CI("status = 'Cancelled'")} AS cancelled, {SI(DONE, 'trip_fare')} AS trip_revenue,
        {SI(DONE, 'trip_fare')} / NULLIF({CI(DONE)}, 0) AS avg_fare, {SI(DONE, 'distance_km')} / NULLIF({CI(DONE)}, 0) AS avg_km, COUNT(DISTINCT customer_id) AS unique_customers,
        COUNT(DISTINCT vehicle_id) AS vehicles_used FROM booked_trips GROUP BY 1""",
)
def _(t):
    n_done = count_if(done())
    return t["booked_trips"].groupBy(fn.month_start("pickup_datetime").alias("month")).agg(
        rows().alias("total_trips"), n_done.alias("completed"), count_if(cancelled()).alias("cancelled"), sum_if(done(), "trip_fare").alias("trip_revenue"),
        ratio(sum_if(done(), "trip_fare"), n_done).alias("avg_fare"), ratio(sum_if(done(), "distance_km"), n_done).alias("avg_km"),
        F.count_distinct("customer_id").alias("unique_customers"), F.count_distinct("vehicle_id").alias("vehicles_used"),
    )


SALARIES = ["1-URGENT", "2-HIGH"]


def pnl_parts(t):
    """Revenue, fuel, maintenance and expenses per fleet, aggregated per member before any join."""

    def per_fleet(df, key, amount, map_view, name):
        small = df.groupBy(key).agg(fn.msum(amount).alias("_s")).join(t[map_view], key)
        return small.groupBy("fleet_id").agg(F.sum("_s").cast("double").alias(name))

    opex = t["opex"].groupBy("customer_id", "category").agg(fn.msum("amount").cast("double").alias("amount"))
    return (
        per_fleet(t["invoices"], "customer_id", "total_amount", "customer_fleet", "revenue"),
        per_fleet(t["fuel_logs"], "driver_id", "fuel_cost", "driver_fleet", "fuel_cost"),
        per_fleet(t["maintenance"], "driver_id", "total_cost", "driver_fleet", "maint_cost"),
        opex.join(t["customer_fleet"], "customer_id").select("fleet_id", "category", "amount"),
    )


PNL_SQL = f"""SELECT fleet_name, revenue, fuel_cost, maint_cost, salary_cost, other_opex, revenue - fuel_cost - maint_cost - salary_cost - other_opex AS net_profit,
    {P('revenue - fuel_cost - maint_cost - salary_cost - other_opex', 'revenue')} AS profit_margin_pct FROM (
    SELECT fleet_name, COALESCE(revenue, 0) AS revenue, COALESCE(fuel_cost, 0) AS fuel_cost, COALESCE(maint_cost, 0) AS maint_cost, COALESCE(salary_cost, 0) AS salary_cost, COALESCE(other_opex, 0) AS other_opex
    FROM fleets LEFT JOIN (SELECT fleet_id, {S('total_amount')} AS revenue FROM fleet_invoices GROUP BY 1) USING (fleet_id)
    LEFT JOIN (SELECT fleet_id, {S('fuel_cost')} AS fuel_cost FROM fuel_logs JOIN driver_fleet USING (driver_id) GROUP BY 1) USING (fleet_id)
    LEFT JOIN (SELECT fleet_id, {S('total_cost')} AS maint_cost FROM maintenance JOIN driver_fleet USING (driver_id) GROUP BY 1) USING (fleet_id)
    LEFT JOIN (SELECT fleet_id, {SI("category IN ('1-URGENT', '2-HIGH')", 'amount')} AS salary_cost, {SI("category NOT IN ('1-URGENT', '2-HIGH')", 'amount')} AS other_opex
        FROM opex JOIN customer_fleet USING (customer_id) GROUP BY 1) USING (fleet_id))"""


@query("q34_fleet_pnl", PNL_SQL)
def _(t):
    return finance.fleet_pnl(t["fleets"], *pnl_parts(t), SALARIES).drop("fleet_id")


@query(
    "q35_city_baseline",
    """SELECT pickup_city, CAST(trip_date AS VARCHAR) AS trip_date, trips, AVG(trips) OVER w AS ma_30d, MAX(trips) OVER w AS peak_30d, trips / AVG(trips) OVER (PARTITION BY pickup_city) AS demand_index
        FROM (SELECT pickup_city, CAST(pickup_datetime AS DATE) AS trip_date, COUNT(*) AS trips FROM city_trips GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY pickup_city ORDER BY trip_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    d = t["city_trips"].groupBy("pickup_city", F.to_date("pickup_datetime").alias("trip_date")).agg(rows().alias("trips"))
    w = Window.partitionBy("pickup_city").orderBy("trip_date").rowsBetween(-29, 0)  # one row per city and day
    return d.withColumns(
        {
            "ma_30d": F.avg("trips").over(w),
            "peak_30d": F.max("trips").over(w),
            "demand_index": ratio("trips", F.avg("trips").over(Window.partitionBy("pickup_city"))),
        }
    )


@query(
    "q36_rate_gap",
    f"""WITH a AS (SELECT category, pickup_city, COUNT(*) AS trip_count, {S('trip_fare')} / {S('duration_days')} AS avg_actual_rate FROM city_trips JOIN vehicles USING (vehicle_id)
            WHERE city_trips.status = 'Completed' GROUP BY 1, 2 HAVING COUNT(*) >= 5), l AS (SELECT category, {A('daily_rate')} AS avg_listed_rate FROM vehicles GROUP BY 1)
        SELECT a.*, avg_listed_rate, avg_actual_rate - avg_listed_rate AS rate_gap, {P('avg_actual_rate - avg_listed_rate', 'avg_listed_rate')} AS rate_gap_pct FROM a LEFT JOIN l USING (category)""",
)
def _(t):
    per = t["city_trips"].where(done()).groupBy("vehicle_id", "pickup_city").agg(
        rows().alias("n"), fn.msum("trip_fare").alias("fare"), fn.msum("duration_days").alias("days")
    )
    a = per.join(t["vehicles"].select("vehicle_id", "category"), "vehicle_id").groupBy("category", "pickup_city").agg(
        F.sum("n").alias("trip_count"), ratio(F.sum("fare"), F.sum("days")).alias("avg_actual_rate")
    )
    listed = t["vehicles"].groupBy("category").agg(davg("daily_rate").alias("avg_listed_rate"))
    gap = F.col("avg_actual_rate") - F.col("avg_listed_rate")
    return a.where(F.col("trip_count") >= 5).join(listed, "category", "left").withColumns({"rate_gap": gap, "rate_gap_pct": pct(gap, "avg_listed_rate")})


@query(
    "q37_downtime",
    f"""SELECT downtime_category, COUNT(*) AS n, AVG(idle_hours) AS avg_idle, MAX(idle_hours) AS max_idle FROM (SELECT idle_hours, CASE WHEN idle_hours < 2 THEN 'Immediate' WHEN idle_hours < 24 THEN 'Same Day'
        WHEN idle_hours < 168 THEN 'Within Week' ELSE 'Extended Downtime' END AS downtime_category FROM (SELECT DATE_DIFF('hour', dropoff_datetime, nxt) AS idle_hours FROM (
        SELECT dropoff_datetime, LEAD(pickup_datetime) OVER (PARTITION BY vehicle_id ORDER BY pickup_datetime, trip_id) AS nxt FROM staged_trips WHERE {DONE}) WHERE nxt IS NOT NULL)) GROUP BY 1""",
)
def _(t):
    d = downtime(t)
    return d.groupBy("downtime_category").agg(rows().alias("n"), F.avg("idle_hours").alias("avg_idle"), F.max("idle_hours").alias("max_idle"))


def downtime(t):
    trips = t["staged_trips"].where(done()).select("vehicle_id", "trip_id", "pickup_datetime", "dropoff_datetime")
    trips = materialise(trips, "staged-trips")
    df = scale.bounded(trips, ["vehicle_id"], ["pickup_datetime", "trip_id"], {"next_pickup": lambda w: F.lead("pickup_datetime").over(w)}, before=0, after=1)
    df = df.where(F.col("next_pickup").isNotNull()).withColumn("idle_hours", fn.hours_between("dropoff_datetime", "next_pickup"))
    return df.withColumn("downtime_category", fn.below("idle_hours", DOWNTIME_CATEGORIES, DOWNTIME_BEYOND))


@query(
    "q38_opex_variance",
    f"""SELECT {D('expense_month')} AS month, category, monthly_spend, LAG(monthly_spend) OVER w AS prev_month_spend, monthly_spend - LAG(monthly_spend) OVER w AS variance,
        {P('monthly_spend - LAG(monthly_spend) OVER w', 'LAG(monthly_spend) OVER w')} AS variance_pct FROM (SELECT expense_month, category, {S('amount')} AS monthly_spend FROM opex GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY category ORDER BY expense_month)""",
)
def _(t):
    m = t["opex"].groupBy(F.col("expense_month").alias("month"), "category").agg(dsum("amount").alias("monthly_spend"))
    g = windows.growth(m, ["category"], "month", "monthly_spend")
    return g.withColumnsRenamed({"prev": "prev_month_spend", "change": "variance", "change_pct": "variance_pct"})


@query(
    "q39_mode_split",
    f"""SELECT *, {P('total_revenue', "(SELECT " + S('trip_fare') + " FROM trips)")} AS revenue_share_pct FROM (SELECT CASE WHEN with_driver THEN 'With Driver' ELSE 'Self-Drive' END AS rental_mode,
        COUNT(*) AS trip_count, {S('trip_fare')} AS total_revenue, {A('trip_fare')} AS avg_fare, {A('distance_km')} AS avg_distance_km, {A('duration_days')} AS avg_duration_days,
        {CI("status = 'Cancelled'")} AS cancellations, {P(CI("status = 'Cancelled'"), 'COUNT(*)')} AS cancel_rate_pct FROM trips GROUP BY 1)""",
)
def _(t):
    mode = F.when(F.col("with_driver"), "With Driver").otherwise("Self-Drive")
    g = t["trips"].groupBy(mode.alias("rental_mode")).agg(
        rows().alias("trip_count"), dsum("trip_fare").alias("total_revenue"), davg("trip_fare").alias("avg_fare"), davg("distance_km").alias("avg_distance_km"),
        davg("duration_days").alias("avg_duration_days"), count_if(cancelled()).alias("cancellations"), pct(count_if(cancelled()), rows()).alias("cancel_rate_pct"),
    )
    total = F.sum(fn.wide_money("total_revenue")).over(Window.partitionBy()).cast("double")  # two rows
    return g.withColumn("revenue_share_pct", pct("total_revenue", total))


@query(
    "q40_category_matrix",
    f"""WITH tr AS (SELECT vehicle_id, COUNT(*) AS n, SUM(CAST(trip_fare AS DECIMAL(18,4))) AS fare, SUM(CAST(distance_km AS DECIMAL(18,4))) AS km FROM trips WHERE {DONE} GROUP BY 1),
        fu AS (SELECT vehicle_id, SUM(CAST(efficiency AS DECIMAL(18,4))) AS eff, COUNT(*) AS fills FROM fuel_logs GROUP BY 1), ma AS (SELECT vehicle_id, SUM(CAST(total_cost AS DECIMAL(18,4))) AS cost FROM maintenance GROUP BY 1)
        SELECT category, COUNT(*) AS vehicle_count, CAST(SUM(n) AS BIGINT) AS total_trips, CAST(SUM(fare) AS DOUBLE) AS total_revenue, CAST(SUM(fare) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS avg_fare,
        CAST(SUM(km) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS avg_km, CAST(SUM(eff) AS DOUBLE) / CAST(SUM(fills) AS DOUBLE) AS avg_fuel_eff, CAST(SUM(cost) AS DOUBLE) AS total_maint_cost,
        CAST(SUM(fare) AS DOUBLE) / NULLIF(CAST(SUM(cost) AS DOUBLE), 0) AS revenue_to_maint_ratio
        FROM vehicles LEFT JOIN tr USING (vehicle_id) LEFT JOIN fu USING (vehicle_id) LEFT JOIN ma USING (vehicle_id) GROUP BY 1""",
)
def _(t):
    tr = t["trips"].where(done()).groupBy("vehicle_id").agg(rows().alias("n"), fn.msum("trip_fare").alias("fare"), fn.msum("distance_km").alias("km"))
    fu = t["fuel_logs"].groupBy("vehicle_id").agg(fn.msum("efficiency").alias("eff"), rows().alias("fills"))
    ma = t["maintenance"].groupBy("vehicle_id").agg(fn.msum("total_cost").alias("cost"))
    df = joins.preaggregated(t["vehicles"].select("vehicle_id", "category"), "vehicle_id", [tr, fu, ma])
    return df.groupBy("category").agg(
        rows().alias("vehicle_count"), F.sum("n").alias("total_trips"), F.sum("fare").cast("double").alias("total_revenue"), ratio(F.sum("fare"), F.sum("n")).alias("avg_fare"),
        ratio(F.sum("km"), F.sum("n")).alias("avg_km"), ratio(F.sum("eff"), F.sum("fills")).alias("avg_fuel_eff"), F.sum("cost").cast("double").alias("total_maint_cost"),
        ratio(F.sum("fare"), F.sum("cost")).alias("revenue_to_maint_ratio"),
    )


@query(
    "q41_weekend",
    f"""SELECT CASE WHEN EXTRACT(isodow FROM trip_date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, EXTRACT(hour FROM trip_date) AS hour_of_day, COUNT(*) AS trip_count,
        {A('speeding_km')} AS avg_value, {S('speeding_km')} AS total_value FROM telematics GROUP BY 1, 2""",
)
def _(t):
    kind = F.when(fn.is_weekend("trip_date"), "Weekend").otherwise("Weekday")
    return t["telematics"].groupBy(kind.alias("day_type"), F.hour("trip_date").cast("bigint").alias("hour_of_day")).agg(
        rows().alias("trip_count"), davg("speeding_km").alias("avg_value"), dsum("speeding_km").alias("total_value")
    )


@query(
    "q42_grouping_sets",
    f"""SELECT customer_type, city, COUNT(DISTINCT customer_id) AS customers, {S('total_amount')} AS total_revenue, {A('total_amount')} AS avg_invoice FROM invoices JOIN customers USING (customer_id)
        GROUP BY GROUPING SETS ((customer_type, city), (customer_type), (city), ())""",
)
def _(t):
    # customers belong to one type and city, so counting them once per cell is exact
    per = t["invoices"].groupBy("customer_id").agg(rows().alias("n"), fn.msum("total_amount").alias("s"))
    base = per.join(t["customers"], "customer_id").groupBy("customer_type", "city").agg(rows().alias("c"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    sets = [[F.col("customer_type"), F.col("city")], [F.col("customer_type")], [F.col("city")], []]
    return base.groupingSets(sets, "customer_type", "city").agg(
        F.sum("c").alias("customers"), F.sum("s").cast("double").alias("total_revenue"), ratio(F.sum("s"), F.sum("n")).alias("avg_invoice")
    )


@query(
    "q43_line_share",
    f"""SELECT l_returnflag AS charge_type, l_linenumber AS description, COUNT(*) AS occurrences, {S('l_extendedprice')} AS total, {A('l_extendedprice')} AS avg_amount,
        {P(S('l_extendedprice'), 'CAST(SUM(SUM(CAST(l_extendedprice AS DECIMAL(18,4)))) OVER () AS DOUBLE)')} AS share_pct FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2""",
)
def _(t):
    g = t["lineitem"].where(F.col("l_returnflag").isin("A", "R")).groupBy(F.col("l_returnflag").alias("charge_type"), F.col("l_linenumber").alias("description")).agg(
        rows().alias("occurrences"), dsum("l_extendedprice").alias("total"), davg("l_extendedprice").alias("avg_amount")
    )
    return share_of_total(g, "total", "share_pct")


@query(
    "q44_salary_roi",
    f"""SELECT driver_id, full_name, profile, salary, salary * 12 AS annual_salary, COALESCE(revenue, 0) AS revenue_generated, COALESCE(n, 0) AS trips_driven,
        COALESCE(revenue, 0) / NULLIF(salary * 12, 0) AS roi_ratio, COALESCE(revenue, 0) - salary * 12 AS net_contribution FROM drivers LEFT JOIN (
        SELECT driver_id, {S('trip_fare')} AS revenue, COUNT(*) AS n FROM trips WHERE {DONE} GROUP BY 1) USING (driver_id) ORDER BY roi_ratio DESC NULLS LAST, driver_id LIMIT 30""",
)
def _(t):
    g = t["trips"].where(done()).groupBy("driver_id").agg(dsum("trip_fare").alias("revenue"), rows().alias("n"))
    annual = F.col("salary") * 12
    df = t["drivers"].join(g, "driver_id", "left").select(
        "driver_id", "full_name", "profile", "salary", annual.alias("annual_salary"), zero("revenue").alias("revenue_generated"), zero_int("n").alias("trips_driven")
    )
    df = df.withColumns({"roi_ratio": ratio("revenue_generated", "annual_salary"), "net_contribution": F.col("revenue_generated") - F.col("annual_salary")})
    return df.orderBy(F.col("roi_ratio").desc_nulls_last(), "driver_id").limit(30)


@query(
    "q45_cancel_rolling",
    f"""SELECT {D('month')} AS month, booking_type, total, cancelled, {P('cancelled', 'total')} AS cancel_rate_pct, ROUND(AVG({P('cancelled', 'total')}) OVER
        (PARTITION BY booking_type ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS rolling_3m_cancel_rate FROM (SELECT {M('pickup_datetime')} AS month, booking_type, COUNT(*) AS total,
        {CI("status = 'Cancelled'")} AS cancelled FROM booked_trips GROUP BY 1, 2)""",
)
def _(t):
    m = t["booked_trips"].groupBy(fn.month_start("pickup_datetime").alias("month"), "booking_type").agg(rows().alias("total"), count_if(cancelled()).alias("cancelled"))
    m = m.withColumn("cancel_rate_pct", pct("cancelled", "total"))
    return m.withColumn("rolling_3m_cancel_rate", F.round(windows.rolling(F.col("cancel_rate_pct"), "month", 3, ["booking_type"]), 9))


@query(
    "q46_geo_cells",
    f"""SELECT pickup_city, ROUND(duration_days, 0) AS x_cell, ROUND(CAST(trip_fare / 10000 AS DECIMAL(18,6)), 0)::DOUBLE AS y_cell, COUNT(*) AS trip_count, {S('trip_fare')} AS zone_revenue,
        {A('distance_km')} AS avg_distance FROM city_trips WHERE {DONE} GROUP BY 1, 2, 3 ORDER BY trip_count DESC, pickup_city, x_cell, y_cell LIMIT 40""",
)
def _(t):
    y = F.round((F.col("trip_fare") / 10000).cast("decimal(18,6)"), 0).cast("double")
    g = t["city_trips"].where(done()).groupBy("pickup_city", F.round("duration_days", 0).alias("x_cell"), y.alias("y_cell")).agg(
        rows().alias("trip_count"), dsum("trip_fare").alias("zone_revenue"), davg("distance_km").alias("avg_distance")
    )
    return g.orderBy(F.desc("trip_count"), "pickup_city", "x_cell", "y_cell").limit(40)


@query(
    "q47_compliance",
    f"""SELECT vehicle_id, make, model, year, {D('insurance_expiry')} AS insurance_expiry, {D('fitness_expiry')} AS fitness_expiry, DATE_DIFF('day', insurance_expiry, DATE '{AS_OF}') AS insurance_days_overdue,
        DATE_DIFF('day', fitness_expiry, DATE '{AS_OF}') AS fitness_days_overdue, CASE WHEN insurance_expiry < DATE '{AS_OF}' THEN 'EXPIRED' ELSE 'Valid' END AS insurance_status,
        CASE WHEN fitness_expiry < DATE '{AS_OF}' THEN 'EXPIRED' ELSE 'Valid' END AS fitness_status, CASE WHEN insurance_expiry < DATE '{AS_OF}' OR fitness_expiry < DATE '{AS_OF}' THEN 'NON-COMPLIANT' ELSE 'COMPLIANT' END AS compliance_flag
        FROM vehicles ORDER BY insurance_days_overdue DESC NULLS LAST, vehicle_id LIMIT 60""",
)
def _(t):
    ins, fit = F.col("insurance_expiry") < as_of(), F.col("fitness_expiry") < as_of()
    df = t["vehicles"].select(
        "vehicle_id", "make", "model", "year", "insurance_expiry", "fitness_expiry",
        fn.days_between("insurance_expiry", as_of()).alias("insurance_days_overdue"), fn.days_between("fitness_expiry", as_of()).alias("fitness_days_overdue"),
        F.when(ins, "EXPIRED").otherwise("Valid").alias("insurance_status"), F.when(fit, "EXPIRED").otherwise("Valid").alias("fitness_status"),
        F.when(ins | fit, "NON-COMPLIANT").otherwise("COMPLIANT").alias("compliance_flag"),
    )
    return df.orderBy(F.col("insurance_days_overdue").desc_nulls_last(), "vehicle_id").limit(60)


def _regression_sql(trips):
    return f"""SELECT trip_id, category, booking_type, distance_km, duration_days, trip_fare, trip_fare / NULLIF(distance_km, 0) AS fare_per_km, trip_fare / NULLIF(duration_days, 0) AS fare_per_day, with_driver
        FROM {trips} b JOIN vehicles USING (vehicle_id) WHERE b.status = 'Completed' AND distance_km > 0 AND duration_days > 0"""


_REG = _regression_sql("booked_trips")
_STAGED_BOOKED = "(SELECT tr.*, o_orderpriority AS booking_type FROM staged_trips tr JOIN orders ON l_orderkey = o_orderkey)"


def regression_frame(t, trips=None):
    trips = (t["booked_trips"] if trips is None else trips).where(done() & (F.col("distance_km") > 0) & (F.col("duration_days") > 0))
    df = trips.join(t["vehicles"].select("vehicle_id", "category"), "vehicle_id")
    return df.select(
        "trip_id", "category", "booking_type", "distance_km", "duration_days", "trip_fare", ratio("trip_fare", "distance_km").alias("fare_per_km"),
        ratio("trip_fare", "duration_days").alias("fare_per_day"), "with_driver",
    )


@query("q48_regression_frame", _REG)
def _(t):
    return regression_frame(t)


@query(
    "q48_regression_sample",
    f"SELECT * FROM ({_regression_sql(_STAGED_BOOKED)}) ORDER BY MD5(CAST(trip_id AS VARCHAR) || ':42'), trip_id LIMIT 500",
)
def _(t):
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("booking_type"))
    return sample_rows(regression_frame(t, t["staged_trips"].join(o, "l_orderkey")), ["trip_id"], 500, 42)


@query(
    "q49_headcount",
    f"""SELECT n_name AS fleet_name, role, headcount, monthly_salary, avg_salary FROM (SELECT s_nationkey AS nk, 'Driver' AS role, COUNT(*) AS headcount, {S('s_acctbal')} AS monthly_salary, {A('s_acctbal')} AS avg_salary
        FROM supplier GROUP BY 1 UNION ALL SELECT c_nationkey, c_mktsegment, COUNT(*), {S('c_acctbal')}, {A('c_acctbal')} FROM customer GROUP BY 1, 2) JOIN nation ON nk = n_nationkey""",
)
def _(t):
    def cost(df, nation, role, pay):
        return df.groupBy(F.col(nation).alias("n_nationkey"), role.alias("role")).agg(rows().alias("headcount"), dsum(pay).alias("monthly_salary"), davg(pay).alias("avg_salary"))

    u = union_all(cost(t["supplier"], "s_nationkey", F.lit("Driver"), "s_acctbal"), cost(t["customer"], "c_nationkey", F.col("c_mktsegment"), "c_acctbal"))
    return u.join(t["nation"], "n_nationkey").select(F.col("n_name").alias("fleet_name"), "role", "headcount", "monthly_salary", "avg_salary")


@query(
    "q50_kpi_all",
    f"""SELECT * FROM (SELECT {S('total_amount')} AS total_billed, {S('paid_amount')} AS total_collected, {S('outstanding')} AS outstanding, {P(S('paid_amount'), S('total_amount'))} AS collection_rate FROM invoices),
        (SELECT COUNT(*) AS total_trips, {CI(DONE)} AS completed, {CI("status = 'Cancelled'")} AS cancelled, {P(CI("status = 'Cancelled'"), 'COUNT(*)')} AS cancel_rate_pct, {SI(DONE, 'trip_fare')} / {CI(DONE)} AS avg_fare, {SI(DONE, 'distance_km')} / {CI(DONE)} AS avg_km FROM trips),
        (SELECT COUNT(*) AS total_vehicles, {CI("status = 'Available'")} AS available, {CI("status = 'On Trip'")} AS on_trip FROM vehicles),
        (SELECT {A('safety_score')} AS avg_safety_score, {CI('accident')} AS total_accidents, {CI('complaint')} AS total_complaints FROM telematics),
        (SELECT {A('efficiency')} AS avg_efficiency, {S('fuel_cost')} AS total_fuel_cost FROM fuel_logs)""",
)
def _(t):
    inv = t["invoices"].agg(dsum("total_amount").alias("total_billed"), dsum("paid_amount").alias("total_collected"), dsum("outstanding").alias("outstanding"))
    inv = inv.withColumn("collection_rate", pct("total_collected", "total_billed"))
    trips = t["trips"].agg(
        rows().alias("total_trips"), count_if(done()).alias("completed"), count_if(cancelled()).alias("cancelled"), pct(count_if(cancelled()), rows()).alias("cancel_rate_pct"),
        ratio(sum_if(done(), "trip_fare"), count_if(done())).alias("avg_fare"), ratio(sum_if(done(), "distance_km"), count_if(done())).alias("avg_km"),
    )
    fleet = t["vehicles"].agg(rows().alias("total_vehicles"), count_if(F.col("status") == "Available").alias("available"), count_if(F.col("status") == "On Trip").alias("on_trip"))
    safety = t["telematics"].agg(davg("safety_score").alias("avg_safety_score"), count_if(F.col("accident")).alias("total_accidents"), count_if(F.col("complaint")).alias("total_complaints"))
    fuel = t["fuel_logs"].agg(davg("efficiency").alias("avg_efficiency"), dsum("fuel_cost").alias("total_fuel_cost"))
    return one_row(inv, trips, fleet, safety, fuel)


def one_row(first, *others):
    """One-row aggregates side by side, as scalar subqueries."""
    cols = []
    for df in others:
        whole = df.select(F.struct(*df.columns).alias("s")).scalar()
        cols += [whole.getField(c).alias(c) for c in df.columns]
    return first.select("*", *cols)


@query(
    "q51_scorecard",
    f"""SELECT driver_id, profile, COUNT(*) AS trips, {A('safety_score')} AS avg_safety_score, AVG(rating) AS avg_rating, {CI('accident')} AS accidents, {CI('complaint')} AS complaints,
        RANK() OVER (ORDER BY {A('safety_score')} DESC) AS safety_rank FROM telematics JOIN telem_drivers USING (driver_id) GROUP BY 1, 2 HAVING COUNT(*) >= 3""",
)
def _(t):
    return scorecard(t)


def scorecard(t):
    g = t["telematics"].groupBy("driver_id").agg(
        rows().alias("trips"), davg("safety_score").alias("avg_safety_score"), F.avg("rating").alias("avg_rating"),
        count_if(F.col("accident")).alias("accidents"), count_if(F.col("complaint")).alias("complaints"),
    )
    df = materialise(g.where(F.col("trips") >= 3).join(t["telem_drivers"], "driver_id"), "scorecard")
    return scale.ranks(df, [], "-avg_safety_score", rank="safety_rank")


@query(
    "q52_efficiency_model",
    f"""SELECT make || ' ' || model AS vehicle, fuel_type, COUNT(*) AS fill_events, {A('efficiency')} AS avg_efficiency, {S('fuel_cost')} AS total_fuel_cost, {S('km_driven')} AS total_km
        FROM fuel_logs JOIN vehicles USING (vehicle_id) WHERE efficiency BETWEEN 3 AND 35 GROUP BY 1, 2""",
)
def _(t):
    f = t["fuel_logs"].where(F.col("efficiency").between(3, 35)).groupBy("vehicle_id", "fuel_type").agg(
        rows().alias("n"), fn.msum("efficiency").alias("e"), fn.msum("fuel_cost").alias("c"), fn.msum("km_driven").alias("k")
    )
    v = t["vehicles"].select("vehicle_id", F.concat_ws(" ", "make", "model").alias("vehicle"))
    return f.join(v, "vehicle_id").groupBy("vehicle", "fuel_type").agg(
        F.sum("n").alias("fill_events"), ratio(F.sum("e"), F.sum("n")).alias("avg_efficiency"), F.sum("c").cast("double").alias("total_fuel_cost"), F.sum("k").cast("double").alias("total_km")
    )


@query(
    "q53_cost_types",
    f"""SELECT make, COUNT(*) AS services, {S('total_cost')} AS total_cost, {A('total_cost')} AS avg_cost, STRING_AGG(DISTINCT maintenance_type, ', ' ORDER BY maintenance_type) AS types
        FROM maintenance JOIN vehicles USING (vehicle_id) GROUP BY 1""",
)
def _(t):
    m = t["maintenance"].groupBy("vehicle_id", "maintenance_type").agg(rows().alias("n"), fn.msum("total_cost").alias("c"))
    df = m.join(t["vehicles"].select("vehicle_id", "make"), "vehicle_id")
    totals = df.groupBy("make").agg(F.sum("n").alias("services"), F.sum("c").cast("double").alias("total_cost"), ratio(F.sum("c"), F.sum("n")).alias("avg_cost"))
    return totals.join(distinct_list(df, ["make"], "maintenance_type", "types"), "make")


@query(
    "q54_quarter_revenue",
    f"SELECT EXTRACT(year FROM invoice_date) AS year, EXTRACT(quarter FROM invoice_date) AS quarter, COUNT(*) AS trips, {S('total_amount')} AS revenue FROM invoices GROUP BY 1, 2",
)
def _(t):
    return t["invoices"].groupBy(F.year("invoice_date").cast("bigint").alias("year"), F.quarter("invoice_date").cast("bigint").alias("quarter")).agg(
        rows().alias("trips"), dsum("total_amount").alias("revenue")
    )


@query(
    "q55_cross_fact",
    f"""SELECT v.vehicle_id, v.make, COALESCE(revenue, 0) AS revenue, COALESCE(maint_cost, 0) AS maint_cost, COALESCE(fuel_cost, 0) AS fuel_cost, COALESCE(revenue, 0) - COALESCE(maint_cost, 0) - COALESCE(fuel_cost, 0) AS margin
        FROM vehicles v LEFT JOIN (SELECT vehicle_id, {S('trip_fare')} AS revenue FROM trips WHERE {DONE} GROUP BY 1) USING (vehicle_id) LEFT JOIN (SELECT vehicle_id, {S('total_cost')} AS maint_cost FROM maintenance GROUP BY 1) USING (vehicle_id)
        LEFT JOIN (SELECT vehicle_id, {S('fuel_cost')} AS fuel_cost FROM fuel_logs GROUP BY 1) USING (vehicle_id)""",
)
def _(t):
    parts = [
        t["trips"].where(done()).groupBy("vehicle_id").agg(dsum("trip_fare").alias("revenue")),
        t["maintenance"].groupBy("vehicle_id").agg(dsum("total_cost").alias("maint_cost")),
        t["fuel_logs"].groupBy("vehicle_id").agg(dsum("fuel_cost").alias("fuel_cost")),
    ]
    df = joins.preaggregated(t["vehicles"].select("vehicle_id", "make"), "vehicle_id", parts)
    df = df.withColumns({c: zero(c) for c in ("revenue", "maint_cost", "fuel_cost")})
    return df.withColumn("margin", F.col("revenue") - F.col("maint_cost") - F.col("fuel_cost"))


@query(
    "q56_funnel_tier",
    f"""SELECT CASE WHEN p = 100 THEN 'Perfect' WHEN p >= 75 THEN 'High' WHEN p >= 50 THEN 'Medium' ELSE 'Low' END AS tier, COUNT(*) AS customers, ROUND(AVG(p), 6) AS avg_pct FROM (
        SELECT customer_id, {P(CI(DONE), 'COUNT(*)')} AS p FROM booked_trips GROUP BY 1) GROUP BY 1""",
)
def _(t):
    p = t["booked_trips"].groupBy("customer_id").agg(pct(count_if(done()), rows()).alias("p"))
    tier = F.when(F.col("p") == 100, "Perfect").when(F.col("p") >= 75, "High").when(F.col("p") >= 50, "Medium").otherwise("Low")
    return p.groupBy(tier.alias("tier")).agg(rows().alias("customers"), F.round(F.avg("p"), 6).alias("avg_pct"))
