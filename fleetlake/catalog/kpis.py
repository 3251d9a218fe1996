"""KPI, alert and report tables on the sample tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF
from fleetlake.catalog.queries import DONE, PNL_SQL, SALARIES, as_of, cancelled, done, driver_kpis, one_row, pnl_parts, route_stats, vehicle_months, _DRIVER_KPIS
from fleetlake.catalog.registry import A, CI, D, M, P, R, S, SI, TS, query
from fleetlake.catalog.windowing import daily_orders, monthly_orders
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import count_if, davg, dsum, pct, ratio, rows, sum_if, zero, zero_int
from fleetlake.models import forecast
from fleetlake.operators import joins, scale, windows
from fleetlake.operators.aggregates import pivot_count, pivot_sum, share_of_total, value_counts
from fleetlake.operators.filters import period_slice
from fleetlake.operators.sets import top_n_per_group, union_all
from fleetlake.plans import finance, reports

CANC = "status = 'Cancelled'"
MONTHS = "(SELECT " + M("invoice_date") + f" AS month, {S('total_amount')} AS billed, {S('paid_amount')} AS collected, {S('outstanding')} AS outstanding, COUNT(*) AS invoices FROM invoices GROUP BY 1)"


def monthly(t):
    return t["invoices"].groupBy(fn.month_start("invoice_date").alias("month")).agg(*[c.alias(n) for n, c in reports.billing_measures().items()])


@query(
    "kpi_executive",
    f"""SELECT *, risky_share FROM (SELECT {S('total_amount')} AS billed, {S('paid_amount')} AS collected, {S('outstanding')} AS outstanding FROM invoices),
        (SELECT {CI(DONE)} AS completed, {P(CI(CANC), 'COUNT(*)')} AS cancel_pct FROM trips), (SELECT {A('safety_score')} AS safety, {CI('accident')} AS accidents FROM telematics),
        (SELECT {CI("status <> 'Retired'")} AS active_vehicles, {CI("status = 'On Trip'")} AS on_trip FROM vehicles), (SELECT {S('fuel_cost')} AS fuel, {A('efficiency')} AS avg_efficiency FROM fuel_logs),
        (SELECT {S('total_cost')} AS maint FROM maintenance), (SELECT {CI("profile IN ('poor', 'dangerous')")} AS risky, {P(CI("profile IN ('poor', 'dangerous')"), 'COUNT(*)')} AS risky_share FROM drivers),
        (SELECT COUNT(*) AS repeat_customers FROM (SELECT customer_id FROM invoices GROUP BY 1 HAVING COUNT(*) > 1))""".replace("SELECT *, risky_share FROM", "SELECT * FROM", 1),
)
def _(t):
    inv = t["invoices"].agg(dsum("total_amount").alias("billed"), dsum("paid_amount").alias("collected"), dsum("outstanding").alias("outstanding"))
    trips = t["trips"].agg(count_if(done()).alias("completed"), pct(count_if(cancelled()), rows()).alias("cancel_pct"))
    tel = t["telematics"].agg(davg("safety_score").alias("safety"), count_if(F.col("accident")).alias("accidents"))
    fleet = t["vehicles"].agg(count_if(F.col("status") != "Retired").alias("active_vehicles"), count_if(F.col("status") == "On Trip").alias("on_trip"))
    fuel = t["fuel_logs"].agg(dsum("fuel_cost").alias("fuel"), davg("efficiency").alias("avg_efficiency"))
    maint = t["maintenance"].agg(dsum("total_cost").alias("maint"))
    bad = F.col("profile").isin("poor", "dangerous")
    risky = t["drivers"].agg(count_if(bad).alias("risky"), pct(count_if(bad), rows()).alias("risky_share"))
    repeat = t["invoices"].groupBy("customer_id").agg(rows().alias("n")).where(F.col("n") > 1).agg(rows().alias("repeat_customers"))
    return one_row(inv, trips, tel, fleet, fuel, maint, risky, repeat)


@query(
    "kpi_utilisation",
    f"""SELECT days_used, fleet, span_days, LEAST(100.0::DOUBLE, days_used * 100.0::DOUBLE / (fleet * span_days)) AS utilisation_pct FROM (SELECT {S('duration_days')} AS days_used,
        DATE_DIFF('day', MIN(pickup_datetime), MAX(pickup_datetime)) + 1 AS span_days FROM trips WHERE {DONE}), (SELECT {CI("status <> 'Retired'")} AS fleet FROM vehicles)""",
)
def _(t):
    used = t["trips"].where(done()).agg(
        dsum("duration_days").alias("days_used"), (fn.days_between(F.min("pickup_datetime"), F.max("pickup_datetime")) + 1).alias("span_days")
    )
    fleet = t["vehicles"].agg(count_if(F.col("status") != "Retired").alias("fleet"))
    df = one_row(used, fleet)
    return df.withColumn("utilisation_pct", F.least(F.lit(100.0), pct("days_used", F.col("fleet") * F.col("span_days"))))


@query("monthly_revenue", f"SELECT {D('month')} AS month, billed, collected, outstanding, invoices FROM {MONTHS}")
def _(t):
    return monthly(t)


@query(
    "vehicle_month_utilisation",
    f"SELECT vehicle_id, {D(M('pickup_datetime'))} AS month, LEAST(100.0::DOUBLE, GREATEST(0.0::DOUBLE, {S('duration_days')} / 30 * 100)) AS utilisation_pct FROM trips WHERE {DONE} GROUP BY 1, 2",
)
def _(t):
    return vehicle_months(t["trips"]).select("vehicle_id", "month", fn.clip(F.col("days_in_use") / 30 * 100, 0.0, 100.0).alias("utilisation_pct"))


@query("driver_safety_summary", f"SELECT k.*, profile FROM {_DRIVER_KPIS} k LEFT JOIN telem_drivers USING (driver_id)")
def _(t):
    return driver_kpis(t["telematics"]).join(t["telem_drivers"], "driver_id", "left")


@query(
    "vehicle_health",
    f"""SELECT vehicle_id, make, COALESCE(maint_cost, 0) AS maint_cost, COALESCE(services, 0) AS services, COALESCE(fuel_cost, 0) AS fuel_cost, avg_efficiency FROM vehicles
        LEFT JOIN (SELECT vehicle_id, {S('total_cost')} AS maint_cost, COUNT(*) AS services FROM maintenance GROUP BY 1) USING (vehicle_id)
        LEFT JOIN (SELECT vehicle_id, {S('fuel_cost')} AS fuel_cost, {A('efficiency')} AS avg_efficiency FROM fuel_logs GROUP BY 1) USING (vehicle_id)""",
)
def _(t):
    parts = [
        t["maintenance"].groupBy("vehicle_id").agg(dsum("total_cost").alias("maint_cost"), rows().alias("services")),
        t["fuel_logs"].groupBy("vehicle_id").agg(dsum("fuel_cost").alias("fuel_cost"), davg("efficiency").alias("avg_efficiency")),
    ]
    df = joins.preaggregated(t["vehicles"].select("vehicle_id", "make"), "vehicle_id", parts)
    return df.withColumns({"maint_cost": zero("maint_cost"), "services": zero_int("services"), "fuel_cost": zero("fuel_cost")})


_WATER = """WITH p AS (SELECT CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue, CAST(SUM(CAST(fuel_cost AS DECIMAL(18,4))) AS DOUBLE) AS fuel, CAST(SUM(CAST(maint_cost AS DECIMAL(18,4))) AS DOUBLE) AS maint,
    CAST(SUM(CAST(salary_cost AS DECIMAL(18,4))) AS DOUBLE) AS salaries, CAST(SUM(CAST(other_opex AS DECIMAL(18,4))) AS DOUBLE) AS other FROM (""" + PNL_SQL + "))"


@query(
    "pnl_waterfall",
    _WATER + """ SELECT 'Revenue' AS step, revenue AS amount FROM p UNION ALL SELECT 'Fuel', -fuel FROM p UNION ALL SELECT 'Maintenance', -maint FROM p UNION ALL SELECT 'Salaries', -salaries FROM p
        UNION ALL SELECT 'Other', -other FROM p UNION ALL SELECT 'Net', revenue - fuel - maint - salaries - other FROM p
        UNION ALL SELECT 'Margin %', (revenue - fuel - maint - salaries - other) * 100.0::DOUBLE / revenue FROM p""",
)
def _(t):
    p = finance.fleet_pnl(t["fleets"], *pnl_parts(t), SALARIES)
    one = p.agg(
        *[fn.wide_sum(c).alias(n) for c, n in (("revenue", "r"), ("fuel_cost", "f"), ("maint_cost", "m"), ("salary_cost", "s"), ("other_opex", "o"))]
    )
    net = F.col("r") - F.col("f") - F.col("m") - F.col("s") - F.col("o")
    steps = {"Revenue": F.col("r"), "Fuel": -F.col("f"), "Maintenance": -F.col("m"), "Salaries": -F.col("s"), "Other": -F.col("o"), "Net": net, "Margin %": pct(net, "r")}
    cells = F.array(*[F.struct(F.lit(n).alias("step"), c.alias("amount")) for n, c in steps.items()])
    return one.select(F.inline(cells))


_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "opex_month_category",
    f"SELECT {D('expense_month')} AS month, " + ", ".join(f"""{SI(f"category = '{c}'", 'amount')} AS \"{c}\"""" for c in _PRIO) + " FROM opex GROUP BY 1",
)
def _(t):
    return pivot_sum(t["opex"], [F.col("expense_month").alias("month")], F.col("category"), _PRIO, F.col("amount"))


_OVER = f"GREATEST(0, DATE_DIFF('day', due_date, DATE '{AS_OF}'))"


@query(
    "ar_aging_clip",
    f"""SELECT bucket, COUNT(*) AS invoices, {S('outstanding')} AS outstanding FROM (SELECT outstanding, CASE WHEN d <= 0 THEN 'Current' WHEN d <= 30 THEN '1-30' WHEN d <= 60 THEN '31-60'
        WHEN d <= 90 THEN '61-90' ELSE '90+' END AS bucket FROM (SELECT outstanding, {_OVER} AS d FROM invoices WHERE outstanding > 0)) GROUP BY 1""",
)
def _(t):
    days = F.greatest(F.lit(0), fn.days_between("due_date", as_of()))
    bucket = fn.cut(days, [-1, 0, 30, 60, 90, 10**9], ["Current", "1-30", "31-60", "61-90", "90+"])
    return t["invoices"].where(F.col("outstanding") > 0).groupBy(bucket.alias("bucket")).agg(rows().alias("invoices"), dsum("outstanding").alias("outstanding"))


@query(
    "top_customers",
    f"SELECT customer_id, full_name, customer_type, revenue, invoices FROM (SELECT customer_id, {S('total_amount')} AS revenue, COUNT(*) AS invoices FROM invoices GROUP BY 1) JOIN customers USING (customer_id) ORDER BY revenue DESC, customer_id LIMIT 10",
)
def _(t):
    g = t["invoices"].groupBy("customer_id").agg(dsum("total_amount").alias("revenue"), rows().alias("invoices"))
    top = g.orderBy(F.desc("revenue"), "customer_id").limit(10)  # ten rows before the join
    return top.join(t["customers"].select("customer_id", "full_name", "customer_type"), "customer_id")


@query(
    "ops_kpis",
    f"""SELECT COUNT(*) AS bookings, {P(CI(DONE), 'COUNT(*)')} AS completed_pct, {P(CI(CANC), 'COUNT(*)')} AS cancelled_pct, {A('distance_km')} AS avg_km, {A('trip_fare')} AS avg_fare, {A('duration_days')} AS avg_duration FROM trips""",
)
def _(t):
    return t["trips"].agg(
        rows().alias("bookings"), pct(count_if(done()), rows()).alias("completed_pct"), pct(count_if(cancelled()), rows()).alias("cancelled_pct"),
        davg("distance_km").alias("avg_km"), davg("trip_fare").alias("avg_fare"), davg("duration_days").alias("avg_duration"),
    )


@query("demand_heatmap", "SELECT DAYNAME(ts) AS dow, " + ", ".join(f"{CI(f'EXTRACT(hour FROM ts) = {h}')} AS h{h}" for h in range(24)) + " FROM events GROUP BY 1")
def _(t):
    return pivot_count(t["events"], [F.date_format("ts", "EEEE").alias("dow")], F.hour("ts"), list(range(24)), "h")


@query(
    "demand_peak",
    """SELECT * FROM (SELECT EXTRACT(hour FROM ts) AS peak_hour, COUNT(*) AS hour_count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
        (SELECT DAYNAME(ts) AS peak_day, COUNT(*) AS day_count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)""",
)
def _(t):
    h = t["events"].groupBy(F.hour("ts").cast("bigint").alias("peak_hour")).agg(rows().alias("hour_count")).orderBy(F.desc("hour_count"), "peak_hour").limit(1)
    d = t["events"].groupBy(F.date_format("ts", "EEEE").alias("peak_day")).agg(rows().alias("day_count")).orderBy(F.desc("day_count"), "peak_day").limit(1)
    return one_row(h, d)


@query("type_month_trend", f"SELECT o_orderpriority AS booking_type, {D(M('o_orderdate'))} AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    return t["orders"].groupBy(F.col("o_orderpriority").alias("booking_type"), fn.month_start("o_orderdate").alias("month")).agg(rows().alias("n"))


@query(
    "route_stats",
    f"""SELECT pickup_city, dropoff_city, COUNT(*) AS trip_count, {A('trip_fare')} AS avg_fare, {A('distance_km')} AS avg_km FROM routed_trips WHERE pickup_city <> dropoff_city GROUP BY 1, 2
        ORDER BY trip_count DESC, pickup_city, dropoff_city LIMIT 15""",
)
def _(t):
    r = route_stats(t["routed_trips"].where(F.col("pickup_city") != F.col("dropoff_city")))
    return r.orderBy(F.desc("trip_count"), "pickup_city", "dropoff_city").limit(15).select("pickup_city", "dropoff_city", "trip_count", "avg_fare", "avg_km")


@query(
    "status_funnel",
    """SELECT o_orderstatus, n, n * 100.0::DOUBLE / MAX(n) OVER () AS pct_of_first FROM (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1)""",
)
def _(t):
    g = t["orders"].groupBy("o_orderstatus").agg(rows().alias("n"))
    return g.withColumn("pct_of_first", pct("n", F.max("n").over(Window.partitionBy())))  # one row per status


@query(
    "driver_radar",
    """SELECT driver_id, GREATEST(0, LEAST(100, 100 - brakes * 0.5::DOUBLE)) AS safe_braking, GREATEST(0, LEAST(100, 100 - accels * 0.5::DOUBLE)) AS smooth_accel,
        GREATEST(0, LEAST(100, 100 - idle * 0.01::DOUBLE)) AS low_idle, GREATEST(0, LEAST(100, 100 - speeding * 0.3::DOUBLE)) AS speed_comply, avg_rating * 20 AS happy_customers FROM (
        SELECT driver_id, SUM(harsh_brakes)::DOUBLE AS brakes, SUM(harsh_accels)::DOUBLE AS accels, SUM(idle_minutes)::DOUBLE AS idle, CAST(SUM(CAST(speeding_km AS DECIMAL(18,4))) AS DOUBLE) AS speeding, AVG(rating) AS avg_rating FROM telematics GROUP BY 1)""",
)
def _(t):
    k = driver_kpis(t["telematics"])
    idle = t["telematics"].groupBy("driver_id").agg(F.sum("idle_minutes").alias("idle"))
    df = k.join(idle, "driver_id")

    def sub(c, weight):
        return fn.clip(100 - F.col(c) * F.lit(weight), 0.0, 100.0)

    return df.select(
        "driver_id", sub("total_harsh_brakes", 0.5).alias("safe_braking"), sub("total_harsh_accels", 0.5).alias("smooth_accel"), sub("idle", 0.01).alias("low_idle"),
        sub("total_speeding_km", 0.3).alias("speed_comply"), (F.col("avg_rating") * 20).alias("happy_customers"),
    )


@query(
    "fuel_month",
    f"SELECT {D(M('fill_date'))} AS month, {A('efficiency')} AS avg_efficiency, {S('fuel_cost')} AS fuel_cost FROM fuel_logs GROUP BY 1",
)
def _(t):
    return t["fuel_logs"].groupBy(fn.month_start("fill_date").alias("month")).agg(davg("efficiency").alias("avg_efficiency"), dsum("fuel_cost").alias("fuel_cost"))


@query("fuel_by_type", f"SELECT fuel_type, {S('fuel_cost')} AS fuel_cost, {S('litres')} AS litres, COUNT(*) AS fills FROM fuel_logs GROUP BY 1")
def _(t):
    return t["fuel_logs"].groupBy("fuel_type").agg(dsum("fuel_cost").alias("fuel_cost"), dsum("litres").alias("litres"), rows().alias("fills"))


@query("maint_by_type", f"SELECT maintenance_type, {S('total_cost')} AS total_cost, COUNT(*) AS services FROM maintenance GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    g = t["maintenance"].groupBy("maintenance_type").agg(dsum("total_cost").alias("total_cost"), rows().alias("services"))
    return g.orderBy(F.desc("total_cost"), "maintenance_type").limit(10)


@query(
    "service_due",
    f"""SELECT vehicle_id, COALESCE(DATE_DIFF('day', last_service, DATE '{AS_OF}'), 180) AS days_since_service FROM vehicles LEFT JOIN (SELECT vehicle_id, MAX(maintenance_date) AS last_service
        FROM maintenance WHERE maintenance_date <= DATE '{AS_OF}' GROUP BY 1) USING (vehicle_id)""",
)
def _(t):
    m = t["maintenance"].where(F.col("maintenance_date") <= as_of())
    last = m.groupBy("vehicle_id").agg(F.max("maintenance_date").alias("last_service"))
    df = t["vehicles"].select("vehicle_id").join(last, "vehicle_id", "left")
    return df.select("vehicle_id", F.coalesce(fn.days_between("last_service", as_of()), F.lit(180).cast("bigint")).alias("days_since_service"))


@query(
    "yoy_revenue",
    f"""SELECT year, revenue, {P('revenue - LAG(revenue) OVER (ORDER BY year)', 'LAG(revenue) OVER (ORDER BY year)')} AS growth_pct FROM (SELECT EXTRACT(year FROM invoice_date) AS year, {S('total_amount')} AS revenue FROM invoices GROUP BY 1)""",
)
def _(t):
    y = t["invoices"].groupBy(F.year("invoice_date").cast("bigint").alias("year")).agg(dsum("total_amount").alias("revenue"))
    return windows.growth(y, [], "year", "revenue").select("year", "revenue", F.col("change_pct").alias("growth_pct"))


@query(
    "season_profile",
    """SELECT month_num, n, n * 1.0::DOUBLE / AVG(n) OVER () AS season_index, CASE WHEN n >= AVG(n) OVER () THEN 'peak' ELSE 'slow' END AS season FROM (SELECT EXTRACT(month FROM o_orderdate) AS month_num, COUNT(*) AS n FROM orders GROUP BY 1)""",
)
def _(t):
    g = t["orders"].groupBy(F.month("o_orderdate").cast("bigint").alias("month_num")).agg(rows().alias("n"))
    mean = F.avg("n").over(Window.partitionBy())  # twelve rows
    return g.withColumns({"season_index": ratio("n", mean), "season": F.when(F.col("n") >= mean, "peak").otherwise("slow")})


@query("city_stats", f"SELECT pickup_city, COUNT(*) AS trips, {S('trip_fare')} AS revenue, {A('trip_fare')} AS avg_fare FROM city_trips GROUP BY 1")
def _(t):
    return t["city_trips"].groupBy("pickup_city").agg(rows().alias("trips"), dsum("trip_fare").alias("revenue"), davg("trip_fare").alias("avg_fare"))


@query(
    "flow_matrix",
    """WITH f AS (SELECT pickup_city, dropoff_city, COUNT(*) AS n FROM routed_trips GROUP BY 1, 2), top AS (SELECT pickup_city AS city FROM f GROUP BY 1 ORDER BY SUM(n) DESC, 1 LIMIT 8)
        SELECT pickup_city, dropoff_city, n FROM f WHERE pickup_city IN (SELECT city FROM top) AND dropoff_city IN (SELECT city FROM top) AND pickup_city <> dropoff_city""",
)
def _(t):
    f = t["routed_trips"].groupBy("pickup_city", "dropoff_city").agg(rows().alias("n"))
    top = f.groupBy("pickup_city").agg(F.sum("n").alias("m")).orderBy(F.desc("m"), "pickup_city").limit(8)
    both = f.join(top.select("pickup_city"), "pickup_city", "left_semi").join(top.select(F.col("pickup_city").alias("dropoff_city")), "dropoff_city", "left_semi")
    return both.where(F.col("pickup_city") != F.col("dropoff_city")).select("pickup_city", "dropoff_city", "n")


def _alert_sql(view, key, docs):
    return " UNION ALL ".join(
        f"""SELECT {key}, '{name}' AS document, {D(col)} AS expiry, CASE WHEN {col} < DATE '{AS_OF}' THEN 'expired' ELSE 'expiring' END AS severity
        FROM {view} WHERE {col} < DATE '{AS_OF}' + 30""" for name, col in docs.items()
    )


_VEHICLE_DOCS = {"insurance": "insurance_expiry", "fitness": "fitness_expiry"}


@query("alerts_expired", _alert_sql("vehicles", "vehicle_id", _VEHICLE_DOCS))
def _(t):
    return reports.expiry_alerts(t["vehicles"], "vehicle_id", _VEHICLE_DOCS, AS_OF)


@query("alerts_license", _alert_sql("drivers", "driver_id", {"licence": "license_expiry"}))
def _(t):
    return reports.expiry_alerts(t["drivers"], "driver_id", {"licence": "license_expiry"}, AS_OF)


@query(
    "alerts_overdue",
    f"""SELECT 'invoice' AS kind, CASE WHEN outstanding > 50000 THEN 'critical' ELSE 'warning' END AS severity, COUNT(*) AS n, {S('outstanding')} AS amount FROM invoices
        WHERE outstanding > 0 AND due_date < DATE '{AS_OF}' GROUP BY 1, 2 UNION ALL
        SELECT 'service', 'warning', COUNT(*), {S('total_cost')} FROM maintenance WHERE status = 'Scheduled' AND next_due_date < DATE '{AS_OF}'""",
)
def _(t):
    inv = t["invoices"].where((F.col("outstanding") > 0) & (F.col("due_date") < as_of()))
    severity = F.when(F.col("outstanding") > 50_000, "critical").otherwise("warning")
    a = inv.groupBy(F.lit("invoice").alias("kind"), severity.alias("severity")).agg(rows().alias("n"), dsum("outstanding").alias("amount"))
    late = t["maintenance"].where((F.col("status") == "Scheduled") & (F.col("next_due_date") < as_of()))
    b = late.agg(rows().alias("n"), dsum("total_cost").alias("amount")).select(F.lit("service").alias("kind"), F.lit("warning").alias("severity"), "n", "amount")
    return union_all(a, b)


_RISK = {"brake_rate": 30, "accel_rate": 25, "idle_rate": 20, "speeding_rate": 25}


@query(
    "driver_risk_index",
    """SELECT driver_id, profile, ROUND(CAST(GREATEST(0, LEAST(100, (brake_rate * 30 + accel_rate * 25 + idle_rate * 20 + speeding_rate * 25) * 100)) AS DECIMAL(18,6)), 1)::DOUBLE AS risk_score FROM drivers""",
)
def _(t):
    return t["drivers"].select("driver_id", "profile", reports.driver_risk_index(_RISK).alias("risk_score"))


@query("fleet_audit", f"""SELECT make, COUNT(*) AS vehicles, {CI("status = 'Available'")} AS available, {CI("status = 'On Trip'")} AS on_trip, {CI("status = 'Maintenance'")} AS in_service, {CI("status = 'Retired'")} AS retired, {CI(f"insurance_expiry < DATE '{AS_OF}'")} AS insurance_expired,
    {CI(f"fitness_expiry < DATE '{AS_OF}'")} AS fitness_expired FROM vehicles GROUP BY 1""")
def _(t):
    return t["vehicles"].groupBy("make").agg(
        rows().alias("vehicles"), count_if(F.col("status") == "Available").alias("available"), count_if(F.col("status") == "Maintenance").alias("in_service"),
        count_if(F.col("status") == "On Trip").alias("on_trip"), count_if(F.col("status") == "Retired").alias("retired"),
        count_if(F.col("insurance_expiry") < as_of()).alias("insurance_expired"), count_if(F.col("fitness_expiry") < as_of()).alias("fitness_expired"),
    )


@query(
    "fleet_audit_issues",
    f"""SELECT vehicle_id, make, CONCAT_WS(', ', CASE WHEN insurance_expiry < DATE '{AS_OF}' THEN 'Insurance expired' END, CASE WHEN fitness_expiry < DATE '{AS_OF}' THEN 'Fitness expired' END,
        CASE WHEN status = 'Maintenance' THEN 'In maintenance' END) AS issues FROM vehicles""",
)
def _(t):
    parts = [
        F.when(F.col("insurance_expiry") < as_of(), "Insurance expired"), F.when(F.col("fitness_expiry") < as_of(), "Fitness expired"),
        F.when(F.col("status") == "Maintenance", "In maintenance"),
    ]
    return t["vehicles"].select("vehicle_id", "make", F.concat_ws(", ", *parts).alias("issues"))


_FMT = {"hour": "%Y-%m-%d %H:00", "day": "%Y-%m-%d", "month": "%Y-%m"}


@query(
    "report_trend",
    " UNION ALL ".join(f"SELECT '{g}' AS granularity, STRFTIME(ts, '{f}') AS period, COUNT(*) AS n, {S('value')} AS total FROM events GROUP BY 1, 2" for g, f in _FMT.items())
    + f" UNION ALL SELECT 'weekday', DAYNAME(ts), COUNT(*), {S('value')} FROM events GROUP BY 1, 2",
)
def _(t):
    parts = []
    for g in ("hour", "day", "month", "weekday"):
        df = reports.trend(t["events"], "ts", g, {"n": rows(), "total": dsum("value")})
        parts.append(df.select(F.lit(g).alias("granularity"), "period", "n", "total"))
    return union_all(*parts)


_PERIOD = ("1999-01-01", "1999-12-31")
_IN = f"BETWEEN TIMESTAMP '{_PERIOD[0]}' AND TIMESTAMP '{_PERIOD[1]}'"


@query(
    "report_financial",
    f"""SELECT *, gross + surcharge - discount AS subtotal, gross + surcharge - discount + tax - opex AS net, {P('gross + surcharge - discount + tax - opex', 'gross')} AS net_margin_pct FROM (
        SELECT {S('l_extendedprice')} AS gross, CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))) AS DOUBLE) AS discount,
        CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4))) AS DOUBLE) AS tax,
        COALESCE(CAST(SUM(CASE WHEN EXTRACT(isodow FROM l_shipdate) >= 6 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,4)) END) AS DOUBLE), 0.0::DOUBLE) AS surcharge FROM lineitem WHERE l_shipdate {_IN}),
        (SELECT {S('amount')} AS opex FROM opex WHERE expense_month BETWEEN DATE '{_PERIOD[0]}' AND DATE '{_PERIOD[1]}')""",
)
def _(t):
    li = period_slice(t["lineitem"], "l_shipdate", *_PERIOD)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    one = li.agg(
        dsum("l_extendedprice").alias("gross"), F.sum((price * F.col("l_discount").cast("decimal(4,2)")).cast(fn.MONEY)).cast("double").alias("discount"),
        F.sum((price * F.col("l_tax").cast("decimal(4,2)")).cast(fn.MONEY)).cast("double").alias("tax"),
        F.coalesce(F.sum(F.when(fn.is_weekend("l_shipdate"), (price * F.lit(0.05).cast("decimal(4,2)")).cast(fn.MONEY))).cast("double"), F.lit(0.0)).alias("surcharge"),
    )
    cost = t["opex"].where(F.col("expense_month").between(*[F.lit(d).cast("date") for d in _PERIOD])).agg(dsum("amount").alias("opex"))
    # the weekend surcharge of 5 percent is billed on top of the gross price
    subtotal = F.col("gross") + F.col("surcharge") - F.col("discount")
    net = subtotal + F.col("tax") - F.col("opex")
    return one_row(one, cost).withColumns({"subtotal": subtotal, "net": net, "net_margin_pct": pct(net, "gross")})


@query(
    "report_maintenance",
    f"""SELECT COUNT(*) AS services, {S('total_cost')} AS total_cost, {A('total_cost')} AS avg_cost, {CI(f"status = 'Scheduled' AND next_due_date < DATE '{AS_OF}'")} AS overdue,
        {CI(f"status = 'Scheduled' AND next_due_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 30")} AS due_soon, {SI("maintenance_type LIKE 'R%'", 'total_cost')} AS parts_cost,
        {SI("maintenance_type NOT LIKE 'R%'", 'total_cost')} AS labour_cost FROM maintenance""",
)
def _(t):
    planned, due = F.col("status") == "Scheduled", F.col("next_due_date")
    is_part = F.col("maintenance_type").startswith("R")
    return t["maintenance"].agg(
        rows().alias("services"), dsum("total_cost").alias("total_cost"), davg("total_cost").alias("avg_cost"), count_if(planned & (due < as_of())).alias("overdue"),
        count_if(planned & due.between(as_of(), F.date_add(as_of(), 30))).alias("due_soon"), sum_if(is_part, "total_cost").alias("parts_cost"), sum_if(~is_part, "total_cost").alias("labour_cost"),
    )


@query("report_maintenance_top", f"SELECT vehicle_id, {S('total_cost')} AS cost, COUNT(*) AS services FROM maintenance GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    g = t["maintenance"].groupBy("vehicle_id").agg(dsum("total_cost").alias("cost"), rows().alias("services"))
    return g.orderBy(F.desc("cost"), "vehicle_id").limit(10)


_SAFE = f"""SELECT COUNT(*) AS trips, {A('safety_score')} AS avg_score, CAST(SUM(harsh_brakes) AS BIGINT) AS brakes, CAST(SUM(harsh_accels) AS BIGINT) AS accels, {S('speeding_km')} AS speeding_km,
    {CI('accident')} AS accidents, {CI('complaint')} AS complaints FROM telematics WHERE trip_date BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-21 23:59:59'"""


@query("report_safety", _SAFE)
def _(t):
    tel = period_slice(t["telematics"], "trip_date", "2024-01-08", "2024-01-21 23:59:59")
    return tel.agg(
        rows().alias("trips"), davg("safety_score").alias("avg_score"), F.sum("harsh_brakes").alias("brakes"), F.sum("harsh_accels").alias("accels"),
        dsum("speeding_km").alias("speeding_km"), count_if(F.col("accident")).alias("accidents"), count_if(F.col("complaint")).alias("complaints"),
    )


@query(
    "report_safety_leaders",
    f"SELECT driver_id, profile, trips, avg_score FROM (SELECT driver_id, COUNT(*) AS trips, {A('safety_score')} AS avg_score FROM telematics GROUP BY 1) JOIN telem_drivers USING (driver_id) ORDER BY avg_score DESC, driver_id LIMIT 20",
)
def _(t):
    g = t["telematics"].groupBy("driver_id").agg(rows().alias("trips"), davg("safety_score").alias("avg_score"))
    return g.join(t["telem_drivers"], "driver_id").orderBy(F.desc("avg_score"), "driver_id").limit(20).select("driver_id", "profile", "trips", "avg_score")


@query(
    "cancel_reasons",
    f"""SELECT COALESCE(NULLIF(l_returnflag, 'N'), 'Unknown') AS reason, COUNT(*) AS row_count, {P('COUNT(*)', '(SELECT COUNT(*) FROM lineitem)')} AS share_pct FROM lineitem GROUP BY 1""",
)
def _(t):
    reason = F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("Unknown"))
    return value_counts(t["lineitem"].select(reason.alias("reason")), "reason")


def _snapshot_sql():
    parts = {
        "billed": f"SELECT {S('total_amount')} FROM invoices", "collected": f"SELECT {S('paid_amount')} FROM invoices", "invoices": "SELECT COUNT(*)::DOUBLE FROM invoices",
        "trips": "SELECT COUNT(*)::DOUBLE FROM trips", "completed": f"SELECT {CI(DONE)}::DOUBLE FROM trips", "trip_revenue": f"SELECT {S('trip_fare')} FROM trips",
        "accidents": f"SELECT {CI('accident')}::DOUBLE FROM telematics", "safety": f"SELECT {A('safety_score')} FROM telematics", "fuel_cost": f"SELECT {S('fuel_cost')} FROM fuel_logs",
        "maint_cost": f"SELECT {S('total_cost')} FROM maintenance", "opex": f"SELECT {S('amount')} FROM opex",
    }
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, ({q}) AS value" for n, q in parts.items())


@query("context_snapshot", _snapshot_sql())
def _(t):
    layers = [
        (t["invoices"], {"billed": dsum("total_amount"), "collected": dsum("paid_amount"), "invoices": rows()}),
        (t["trips"], {"trips": rows(), "completed": count_if(done()), "trip_revenue": dsum("trip_fare")}),
        (t["telematics"], {"accidents": count_if(F.col("accident")), "safety": davg("safety_score")}),
        (t["fuel_logs"], {"fuel_cost": dsum("fuel_cost")}),
        (t["maintenance"], {"maint_cost": dsum("total_cost")}),
        (t["opex"], {"opex": dsum("amount")}),
    ]
    return union_all(*[reports.metric_layer(df, m) for df, m in layers])


@query(
    "top_vehicles",
    f"SELECT vehicle_id, make || ' ' || model AS label, category, revenue, trips FROM (SELECT vehicle_id, {S('trip_fare')} AS revenue, COUNT(*) AS trips FROM trips WHERE {DONE} GROUP BY 1) JOIN vehicles USING (vehicle_id) ORDER BY revenue DESC, vehicle_id LIMIT 10",
)
def _(t):
    g = t["trips"].where(done()).groupBy("vehicle_id").agg(dsum("trip_fare").alias("revenue"), rows().alias("trips"))
    top = g.orderBy(F.desc("revenue"), "vehicle_id").limit(10)
    v = t["vehicles"].select("vehicle_id", F.concat_ws(" ", "make", "model").alias("label"), "category")
    return top.join(v, "vehicle_id")


@query("latest_month", f"SELECT {D('month')} AS month, billed, collected, outstanding, invoices FROM {MONTHS} ORDER BY month DESC LIMIT 1")
def _(t):
    return monthly(t).orderBy(F.desc("month")).limit(1)


@query(
    "same_month_yoy",
    f"""SELECT {D('month')} AS month, EXTRACT(month FROM month) AS month_num, billed, {P('billed - LAG(billed) OVER w', 'LAG(billed) OVER w')} AS yoy_pct FROM {MONTHS} WINDOW w AS (PARTITION BY EXTRACT(month FROM month) ORDER BY month)""",
)
def _(t):
    m = monthly(t).withColumn("month_num", F.month("month").cast("bigint"))
    return windows.growth(m, ["month_num"], "month", "billed").select("month", "month_num", "billed", F.col("change_pct").alias("yoy_pct"))


@query(
    "best_worst_drivers",
    f"""WITH g AS (SELECT driver_id, {A('safety_score')} AS avg_score, COUNT(*) AS trips FROM telematics GROUP BY 1) SELECT * FROM (SELECT 'best' AS side, * FROM g ORDER BY avg_score DESC, driver_id LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'worst' AS side, * FROM g ORDER BY avg_score, driver_id LIMIT 5)""",
)
def _(t):
    g = t["telematics"].groupBy("driver_id").agg(davg("safety_score").alias("avg_score"), rows().alias("trips"))
    best = g.orderBy(F.desc("avg_score"), "driver_id").limit(5).select(F.lit("best").alias("side"), "*")
    worst = g.orderBy("avg_score", "driver_id").limit(5).select(F.lit("worst").alias("side"), "*")
    return union_all(best, worst)


@query(
    "fleet_month_utilisation",
    f"""SELECT {D(M('pickup_datetime'))} AS month, {S('duration_days')} * 100.0::DOUBLE / ((SELECT COUNT(*) FROM vehicles) * 30) AS utilisation_pct FROM trips WHERE {DONE} GROUP BY 1""",
)
def _(t):
    fleet = t["vehicles"].agg(rows()).scalar()
    m = t["trips"].where(done()).groupBy(fn.month_start("pickup_datetime").alias("month")).agg(dsum("duration_days").alias("d"))
    return m.select("month", pct("d", fleet * 30).alias("utilisation_pct"))


@query(
    "fleet_collection",
    f"SELECT fleet_name, {S('total_amount')} AS billed, {S('paid_amount')} AS collected, {P(S('paid_amount'), S('total_amount'))} AS rate_pct FROM fleet_invoices JOIN fleets USING (fleet_id) GROUP BY 1",
)
def _(t):
    g = t["fleet_invoices"].groupBy("fleet_id").agg(dsum("total_amount").alias("billed"), dsum("paid_amount").alias("collected"))
    return g.join(t["fleets"], "fleet_id").select("fleet_name", "billed", "collected", pct("collected", "billed").alias("rate_pct"))


@query(
    "profile_scores",
    f"SELECT profile, COUNT(*) AS drivers, ROUND(AVG(m), 9) AS mean_score FROM (SELECT driver_id, {A('safety_score')} AS m FROM telematics GROUP BY 1) JOIN telem_drivers USING (driver_id) GROUP BY 1",
)
def _(t):
    g = t["telematics"].groupBy("driver_id").agg(davg("safety_score").alias("m")).join(t["telem_drivers"], "driver_id")
    return g.groupBy("profile").agg(rows().alias("drivers"), F.round(F.avg("m"), 9).alias("mean_score"))


@query(
    "segment_spend",
    f"SELECT customer_type, {S('total_amount')} AS revenue, COUNT(DISTINCT customer_id) AS customers, {S('total_amount')} / COUNT(DISTINCT customer_id) AS avg_spend FROM invoices JOIN customers USING (customer_id) GROUP BY 1",
)
def _(t):
    per = t["invoices"].groupBy("customer_id").agg(fn.msum("total_amount").alias("s"))
    g = per.join(t["customers"], "customer_id").groupBy("customer_type").agg(F.sum("s").cast("double").alias("revenue"), rows().alias("customers"))
    return g.withColumn("avg_spend", ratio("revenue", "customers"))


@query(
    "method_collection",
    f"SELECT payment_method, {S('total_amount')} AS revenue, COUNT(*) AS invoices, {S('paid_amount')} AS collected, {P(S('paid_amount'), S('total_amount'))} AS rate_pct FROM invoices GROUP BY 1",
)
def _(t):
    g = t["invoices"].groupBy("payment_method").agg(dsum("total_amount").alias("revenue"), rows().alias("invoices"), dsum("paid_amount").alias("collected"))
    return g.withColumn("rate_pct", pct("collected", "revenue"))


@query(
    "kpi_unit_costs",
    f"""SELECT revenue / vehicles AS revenue_per_vehicle, fuel / km AS fuel_cost_per_km, completion_pct FROM (SELECT {S('trip_fare')} AS revenue, {P(CI(DONE), 'COUNT(*)')} AS completion_pct FROM trips),
        (SELECT COUNT(*) AS vehicles FROM vehicles), (SELECT {S('fuel_cost')} AS fuel, {S('km_driven')} AS km FROM fuel_logs)""",
)
def _(t):
    one = one_row(
        t["trips"].agg(dsum("trip_fare").alias("revenue"), pct(count_if(done()), rows()).alias("completion_pct")),
        t["vehicles"].agg(rows().alias("vehicles")),
        t["fuel_logs"].agg(dsum("fuel_cost").alias("fuel"), dsum("km_driven").alias("km")),
    )
    return one.select(ratio("revenue", "vehicles").alias("revenue_per_vehicle"), ratio("fuel", "km").alias("fuel_cost_per_km"), "completion_pct")


_UTILISATION_SQL = f"""SELECT LEAST(100.0::DOUBLE, days_used * 100.0::DOUBLE / (fleet * span_days)) FROM (SELECT {S('duration_days')} AS days_used,
    DATE_DIFF('day', MIN(pickup_datetime), MAX(pickup_datetime)) + 1 AS span_days FROM trips WHERE {DONE}), (SELECT {CI("status <> 'Retired'")} AS fleet FROM vehicles)"""
_CHURN_SQL = f"SELECT {P(CI('days > 180'), 'COUNT(*)')} FROM (SELECT customer_id, DATE_DIFF('day', MAX(invoice_date), DATE '{AS_OF}') AS days FROM invoices GROUP BY 1)"


def utilisation(t):
    """Vehicle days used as a share of the vehicle days on hand, at most 100 percent; one row."""
    used = t["trips"].where(done()).agg(
        dsum("duration_days").alias("days_used"), (fn.days_between(F.min("pickup_datetime"), F.max("pickup_datetime")) + 1).alias("span_days")
    )
    fleet = t["vehicles"].agg(count_if(F.col("status") != "Retired").alias("fleet"))
    return one_row(used, fleet).select(F.least(F.lit(100.0), pct("days_used", F.col("fleet") * F.col("span_days"))).alias("utilisation"))


def _metrics_sql():
    m = {
        "gross_revenue": S("trip_fare"), "avg_fare": A("trip_fare"), "cancel_rate": P(CI(CANC), "COUNT(*)"), "active_customers": "COUNT(DISTINCT customer_id)::DOUBLE",
        "revenue_per_km": f"{S('trip_fare')} / {S('distance_km')}", "vehicles_used": "COUNT(DISTINCT vehicle_id)::DOUBLE", "dq_rate": P(CI("pickup_datetime < booking_datetime"), "COUNT(*)"),
    }
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, {c} AS value FROM booked_trips" for n, c in m.items()) + f" UNION ALL SELECT 'utilisation', ({_UTILISATION_SQL}) UNION ALL SELECT 'churn_rate', ({_CHURN_SQL})"


@query("metric_layer", _metrics_sql())
def _(t):
    last = t["invoices"].groupBy("customer_id").agg(F.max("invoice_date").alias("last"))
    gone = fn.days_between("last", as_of()) > 180
    booked = reports.metric_layer(
        t["booked_trips"],
        {
            "gross_revenue": dsum("trip_fare"), "avg_fare": davg("trip_fare"), "cancel_rate": pct(count_if(cancelled()), rows()), "active_customers": F.count_distinct("customer_id"),
            "revenue_per_km": ratio(dsum("trip_fare"), dsum("distance_km")), "vehicles_used": F.count_distinct("vehicle_id"),
            "dq_rate": pct(count_if(F.col("pickup_datetime") < F.col("booking_datetime")), rows()),
        },
    )
    return union_all(booked, reports.unpivot_row(utilisation(t)), reports.metric_layer(last, {"churn_rate": pct(count_if(gone), rows())}))


def _flags_sql():
    vals = {
        "collection_rate": f"SELECT {P(S('paid_amount'), S('total_amount'))} FROM invoices", "cancel_rate": f"SELECT {P(CI(CANC), 'COUNT(*)')} FROM trips",
        "safety_score": f"SELECT {A('safety_score')} FROM telematics", "fuel_efficiency": f"SELECT {A('efficiency')} FROM fuel_logs",
        "repeat_rate": f"SELECT {P(CI('n > 1'), 'COUNT(*)')} FROM (SELECT customer_id, COUNT(*) AS n FROM invoices GROUP BY 1)",
        "utilisation": _UTILISATION_SQL,
    }
    rules = {"collection_rate": (92, 80, 1), "cancel_rate": (8, 15, 0), "safety_score": (70, 55, 1), "fuel_efficiency": (12, 9, 1), "repeat_rate": (40, 0, 1), "utilisation": (65, 45, 1)}
    out = []
    for n, q in vals.items():
        g, w, up = rules[n]
        op = ">=" if up else "<"
        out.append(f"SELECT '{n}' AS metric, v AS value, CASE WHEN v {op} {g} THEN 'good' WHEN v {op} {w} THEN 'warn' ELSE 'bad' END AS level FROM (SELECT ({q}) AS v)")
    return " UNION ALL ".join(out)


@query("kpi_flags", _flags_sql())
def _(t):
    per_customer = t["invoices"].groupBy("customer_id").agg(rows().alias("n"))
    metrics = union_all(
        reports.metric_layer(t["invoices"], {"collection_rate": pct(dsum("paid_amount"), dsum("total_amount"))}),
        reports.metric_layer(t["trips"], {"cancel_rate": pct(count_if(cancelled()), rows())}),
        reports.metric_layer(t["telematics"], {"safety_score": davg("safety_score")}),
        reports.metric_layer(t["fuel_logs"], {"fuel_efficiency": davg("efficiency")}),
        reports.metric_layer(per_customer, {"repeat_rate": pct(count_if(F.col("n") > 1), rows())}),
        reports.unpivot_row(utilisation(t)),
    )
    return reports.kpi_flags(metrics)


@query(
    "month_insight",
    f"""WITH m AS (SELECT month, billed, LAG(billed) OVER (ORDER BY month) AS prev FROM {MONTHS}) SELECT * FROM (SELECT {D('month')} AS last_month, billed, {P('billed - prev', 'prev')} AS growth_pct FROM m ORDER BY month DESC LIMIT 1),
        (SELECT {D('month')} AS peak_month FROM m ORDER BY billed DESC, month LIMIT 1), (SELECT {D('month')} AS slow_month FROM m ORDER BY billed, month LIMIT 1)""",
)
def _(t):
    m = windows.growth(monthly(t), [], "month", "billed")
    return m.agg(
        F.max("month").alias("last_month"), F.max_by("billed", "month").alias("billed"), F.max_by("change_pct", "month").alias("growth_pct"),
        F.max_by("month", "billed").alias("peak_month"), F.min_by("month", "billed").alias("slow_month"),
    )


@query(
    "efficiency_trend",
    f"""SELECT {D('month')} AS month, avg_efficiency, avg_efficiency - LAG(avg_efficiency, 2) OVER (ORDER BY month) AS change_2m FROM (SELECT {M('fill_date')} AS month, {A('efficiency')} AS avg_efficiency FROM fuel_logs GROUP BY 1)""",
)
def _(t):
    m = t["fuel_logs"].groupBy(fn.month_start("fill_date").alias("month")).agg(davg("efficiency").alias("avg_efficiency"))
    before = F.lag("avg_efficiency", 2).over(Window.orderBy("month"))  # one row per month
    return m.withColumn("change_2m", F.col("avg_efficiency") - before)


@query(
    "customer_mix",
    f"""SELECT {P(CI("customer_type = 'BUILDING'"), 'COUNT(*)')} AS corporate_pct, {P(CI("customer_type = 'MACHINERY'"), 'COUNT(*)')} AS overseas_pct, {P(CI('n > 1'), 'COUNT(*)')} AS repeat_pct, {S('spend')} / COUNT(*) AS avg_spend
        FROM customers LEFT JOIN (SELECT customer_id, COUNT(*) AS n, {S('total_amount')} AS spend FROM invoices GROUP BY 1) USING (customer_id)""",
)
def _(t):
    per = t["invoices"].groupBy("customer_id").agg(rows().alias("n"), dsum("total_amount").alias("spend"))
    df, kind = t["customers"].join(per, "customer_id", "left"), F.col("customer_type")
    return df.agg(
        pct(count_if(kind == "BUILDING"), rows()).alias("corporate_pct"), pct(count_if(kind == "MACHINERY"), rows()).alias("overseas_pct"),
        pct(count_if(F.col("n") > 1), rows()).alias("repeat_pct"), ratio(dsum("spend"), rows()).alias("avg_spend"),
    )


_DAILY = f"(SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, {S('o_totalprice')} AS revenue FROM orders GROUP BY 1)"


@query(
    "forecast_summary",
    f"""SELECT AVG(CASE WHEN EXTRACT(isodow FROM day) < 6 THEN n END) AS weekday_mean, AVG(CASE WHEN EXTRACT(isodow FROM day) >= 6 THEN n END) AS weekend_mean,
        (SELECT {D('day')} FROM {_DAILY} ORDER BY n DESC, day LIMIT 1) AS peak_day, MAX(n) AS peak FROM {_DAILY}""",
)
def _(t):
    d, off = daily_orders(t), fn.is_weekend("day")
    return d.agg(
        F.avg(F.when(~off, F.col("n"))).alias("weekday_mean"), F.avg(F.when(off, F.col("n"))).alias("weekend_mean"),
        F.max_by("day", F.struct("n", -F.unix_date("day"))).alias("peak_day"), F.max("n").alias("peak"),
    )


@query("forecast_outlook")
def _(t):
    """Per fleet: growth of the revenue forecast against the last actual month, and its peak month."""
    series = forecast.revenue_forecast(t["fleet_invoices"], "fleet_id", "invoice_date", "total_amount")
    actual = t["fleet_invoices"].groupBy("fleet_id", fn.month_start("invoice_date").alias("month")).agg(dsum("total_amount").alias("revenue"))
    last = actual.groupBy("fleet_id").agg(F.max_by("revenue", "month").alias("last_actual"), F.max("month").alias("last_month"))
    return forecast.outlook(series, last, "fleet_id")


@query(
    "monthly_events",
    """SELECT STRFTIME(ts, '%Y-%m') AS period, COUNT(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def _(t):
    return reports.trend(t["events"].where(F.col("event_type") == "error"), "ts", "month", {"errors": rows()})


@query("monthly_maintenance", f"SELECT {D(M('maintenance_date'))} AS month, {S('total_cost')} AS total_cost, COUNT(*) AS services FROM maintenance GROUP BY 1")
def _(t):
    return t["maintenance"].groupBy(fn.month_start("maintenance_date").alias("month")).agg(dsum("total_cost").alias("total_cost"), rows().alias("services"))
