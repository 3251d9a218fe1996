"""Warehouse jobs and business rules on the sample tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF, FOREIGN_KEYS
from fleetlake.catalog.queries import DONE
from fleetlake.catalog.registry import A, CI, D, M, P, S, SI, TS, query
from fleetlake.catalog.relational import CUTOFF, _steps_sql
from fleetlake.constants import BOOKING_MULTIPLIERS, EXPENSE_SHARES, FUEL_PRICE_TIMELINE
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import dsum, rows
from fleetlake.operators import joins, scale
from fleetlake.operators.sets import union_all
from fleetlake.session import scratch_path
from fleetlake.sources import sinks
from fleetlake.warehouse import dims, load, marts, rules, snapshots

HOLIDAYS = ["01-01", "12-25"]

# --- staging and dimensions ---


@query(
    "stage_table",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, GREATEST(l_quantity, 5) AS quantity, l_extendedprice AS price, UPPER(SUBSTR(p_name, 1, 1)) || LOWER(SUBSTR(SPLIT_PART(p_name, ' ', 1), 2)) || ' '
        || UPPER(SUBSTR(SPLIT_PART(p_name, ' ', 2), 1, 1)) || LOWER(SUBSTR(SPLIT_PART(p_name, ' ', 2), 2)) AS item, l_discount = 0 AS _dq_no_discount FROM staged_lineitem JOIN part ON l_partkey = p_partkey""",
)
def _(t):
    # raw text columns, as a CSV drop would deliver them
    li = t["lineitem"]
    raw = li.select(
        *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_tax", "l_returnflag", "l_linestatus", "l_discount"],
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")).alias("quantity"), F.col("l_extendedprice").cast("string").alias("price"),
    )
    order = ["-l_shipdate", "-l_partkey", "-l_suppkey", "-quantity", "-price", "-l_discount", "-l_tax", "-l_returnflag", "-l_linestatus"]
    # the clamp would hide quantities the copies are ordered by, so it follows the staging step
    df = load.stage(
        raw, {"quantity": "double", "price": "double"}, {"quantity": 1.0, "price": 0.0}, ["l_orderkey", "l_linenumber"], order,
        flags={"no_discount": F.col("l_discount") == 0},
    )
    item = t["part"].select(F.col("p_partkey").alias("l_partkey"), F.initcap("p_name").alias("item"))
    return df.join(item, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", F.greatest("quantity", F.lit(5.0)).alias("quantity"), "price", "item", "_dq_no_discount")


@query(
    "dim_date",
    f"""WITH RECURSIVE b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders), s AS (SELECT lo AS d FROM b UNION ALL SELECT d + 1 FROM s WHERE d < (SELECT hi FROM b))
        SELECT CAST(STRFTIME(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS date, CAST(EXTRACT(year FROM d) AS INTEGER) AS year, CAST(EXTRACT(quarter FROM d) AS INTEGER) AS quarter,
        CAST(EXTRACT(month FROM d) AS INTEGER) AS month, CAST(EXTRACT(day FROM d) AS INTEGER) AS day, EXTRACT(year FROM d) || '-Q' || EXTRACT(quarter FROM d) AS quarter_label, MONTHNAME(d) AS month_name,
        DAYNAME(d) AS day_name, EXTRACT(isodow FROM d) >= 6 AS is_weekend, STRFTIME(d, '%m-%d') IN ('01-01', '12-25') AS is_holiday FROM s""",
)
def _(t):
    return dims.dim_date(t["orders"], "o_orderdate", HOLIDAYS)


def _customer_dim(t):
    c = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_id"))
    return dims.scd2_initial(c, "1995-01-01")


def _customer_batch(t):
    """Source extract in which in-debt customers changed segment, plus one new member per existing supplier."""
    seg = F.when(F.col("c_acctbal") < 0, "RECOVERY").otherwise(F.col("c_mktsegment"))
    c = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), seg.alias("segment"), F.col("c_nationkey").alias("nation_id"))
    s = t["supplier"].select(
        (F.col("s_suppkey") + 1_000_000_000_000).alias("customer_id"), F.col("s_name").alias("full_name"), F.lit("SUPPLIER").alias("segment"), F.col("s_nationkey").alias("nation_id")
    )
    return union_all(c, s)


_SCD2 = """SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment, c_nationkey AS nation_id, DATE '1995-01-01' AS valid_from,
        CASE WHEN c_acctbal < 0 THEN DATE '1998-06-30' ELSE DATE '9999-12-31' END AS valid_to, c_acctbal >= 0 AS is_current FROM customer
    UNION ALL SELECT c_custkey, c_name, 'RECOVERY', c_nationkey, DATE '1998-07-01', DATE '9999-12-31', TRUE FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT s_suppkey + 1000000000000, s_name, 'SUPPLIER', s_nationkey, DATE '1998-07-01', DATE '9999-12-31', TRUE FROM supplier"""


def customer_scd2(t):
    return dims.scd2_apply(_customer_dim(t), _customer_batch(t), "customer_id", ["full_name", "segment", "nation_id"], "1998-07-01")


@query("dim_scd2", f"SELECT customer_id, full_name, segment, nation_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM ({_SCD2})")
def _(t):
    return customer_scd2(t)


@query("dim_scd2_rerun", f"SELECT customer_id, full_name, segment, nation_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM ({_SCD2})")
def _(t):
    return dims.scd2_apply(customer_scd2(t), _customer_batch(t), "customer_id", ["full_name", "segment", "nation_id"], "1998-07-01")


def vehicle_dim(t):
    v = t["vehicles"].select("vehicle_id", "make", "model", "category", "year")
    return dims.with_surrogate_keys(v, "vehicle_id", "vehicle_key", {"vehicle_id": -1, "make": "Unknown", "model": "Unknown", "category": "Unknown"})


def driver_dim(t):
    d = t["drivers"].select("driver_id", "full_name", "profile").join(t["driver_fleet"], "driver_id")
    return dims.with_surrogate_keys(d, "driver_id", "driver_key", {"driver_id": -1, "full_name": "Unknown", "profile": "Unknown"})


@query(
    "dim_conformed",
    """SELECT vehicle_id, make, model, category, year, ROW_NUMBER() OVER (ORDER BY vehicle_id) AS vehicle_key FROM vehicles UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', NULL, -1""",
)
def _(t):
    return vehicle_dim(t)


@query(
    "dim_driver",
    """SELECT driver_id, full_name, profile, fleet_id, ROW_NUMBER() OVER (ORDER BY driver_id) AS driver_key FROM drivers JOIN driver_fleet USING (driver_id)
        UNION ALL SELECT -1, 'Unknown', 'Unknown', NULL, -1""",
)
def _(t):
    return driver_dim(t)


@query(
    "dim_location",
    """SELECT n_nationkey AS location_id, n_name AS city, r_name AS fleet_name, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS location_key FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT -1, 'Unknown', 'Unknown', -1""",
)
def _(t):
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    places = places.select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("city"), F.col("r_name").alias("fleet_name"))
    return dims.with_surrogate_keys(places, "location_id", "location_key", {"location_id": -1, "city": "Unknown", "fleet_name": "Unknown"})


# --- facts and marts ---


def fact_trips(t):
    # members of retired vehicles are left out of the dimension, so their trips point to -1
    active = t["vehicles"].where(F.col("status") != "Retired").select("vehicle_id")
    vdim = vehicle_dim(t)
    vdim = vdim.join(active, "vehicle_id", "left_semi")
    staged = t["staged_trips"]
    orders = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("booking_datetime"))
    return marts.fact_trips(staged.join(orders, "l_orderkey"), vdim, driver_dim(t))


_FACT = f"""(SELECT trip_id, CAST(STRFTIME(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key, COALESCE(vk, -1) AS vehicle_key, COALESCE(dk, -1) AS driver_key, o_custkey AS customer_id,
    CAST(pickup_datetime AS DATE) AS trip_date, duration_days, distance_km, trip_fare, trip_fare / duration_days AS revenue_per_day, trip_fare / distance_km AS revenue_per_km,
    tr.status = 'Completed' AS is_completed, tr.status = 'Cancelled' AS is_cancelled, with_driver, pickup_datetime < o_orderdate AS _dq_timeline
    FROM staged_trips tr JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT vehicle_id, vk FROM (SELECT vehicle_id, status, ROW_NUMBER() OVER (ORDER BY vehicle_id) AS vk FROM vehicles) WHERE status <> 'Retired') v USING (vehicle_id)
    LEFT JOIN (SELECT driver_id, ROW_NUMBER() OVER (ORDER BY driver_id) AS dk FROM drivers) d USING (driver_id))"""


@query("fact_trips", f"SELECT * EXCLUDE (trip_date), CAST(trip_date AS VARCHAR) AS trip_date FROM {_FACT}")
def _(t):
    return fact_trips(t)


def vehicle_versions(t):
    """Each vehicle before and from its rebuild, on a day of 1997 that depends on its number; one surrogate key per version."""
    v = t["vehicles"].select("vehicle_id", F.date_add(F.lit("1997-01-01").cast("date"), (F.col("vehicle_id") % 365).cast("int")).alias("rebuilt"))
    both = F.array(
        F.struct((F.col("vehicle_id") * 2).alias("vehicle_key"), F.lit("1900-01-01").cast("date").alias("valid_from"), F.date_sub("rebuilt", 1).alias("valid_to")),
        F.struct((F.col("vehicle_id") * 2 + 1).alias("vehicle_key"), F.col("rebuilt").alias("valid_from"), F.lit("2000-12-31").cast("date").alias("valid_to")),
    )
    return v.select("vehicle_id", F.inline(both))


@query(
    "fact_trips_versions",
    """WITH v AS (SELECT vehicle_id, CAST(DATE '1997-01-01' + CAST(vehicle_id % 365 AS INTEGER) AS DATE) AS rebuilt FROM vehicles), k AS (SELECT trip_id, vehicle_id, CAST(pickup_datetime AS DATE) AS day FROM staged_trips)
        SELECT trip_id, CAST(CASE WHEN rebuilt IS NULL OR day > DATE '2000-12-31' THEN -1 WHEN day < rebuilt THEN vehicle_id * 2 ELSE vehicle_id * 2 + 1 END AS BIGINT) AS vehicle_key FROM k LEFT JOIN v USING (vehicle_id)""",
)
def _(t):
    return dims.lookup_at(t["staged_trips"].select("trip_id", "vehicle_id", "pickup_datetime"), vehicle_versions(t), "vehicle_id", "vehicle_key", "pickup_datetime").select("trip_id", "vehicle_key")


_KEY = "CAST(STRFTIME({c}, '%Y%m%d') AS INTEGER)"


@query(
    "fact_invoices",
    f"""SELECT invoice_id, customer_id, {_KEY.format(c='invoice_date')} AS date_key, {_KEY.format(c='due_date')} AS due_date_key, CAST(invoice_date AS VARCHAR) AS invoice_date, total_amount, paid_amount, outstanding,
        outstanding = 0 AS is_paid, {P('paid_amount', 'total_amount')} AS paid_pct FROM invoices""",
)
def _(t):
    return marts.fact_invoices(t["invoices"])


@query(
    "fact_telematics",
    f"""SELECT telem_id, driver_id, {_KEY.format(c='trip_date')} AS date_key, safety_score, harsh_brakes + harsh_accels AS harsh_events, idle_minutes, speeding_km, CAST(accident AS INTEGER) AS accident,
        CAST(complaint AS INTEGER) AS complaint, rating FROM telematics""",
)
def _(t):
    return marts.fact_telematics(t["telematics"])


@query(
    "fact_payments",
    f"""SELECT invoice_id, customer_id, {_KEY.format(c='invoice_date')} AS date_key, payment_method, paid_amount, outstanding = 0 AS settles_invoice FROM invoices WHERE paid_amount > 0""",
)
def _(t):
    return marts.fact_payments(t["invoices"])


_VK = "(SELECT vehicle_id, ROW_NUMBER() OVER (ORDER BY vehicle_id) AS vehicle_key FROM vehicles)"


@query(
    "fact_fuel",
    f"""SELECT fuel_id, vehicle_key, {_KEY.format(c='fill_date')} AS date_key, fuel_type, litres, km_driven, fuel_cost, fuel_cost / litres AS cost_per_litre FROM fuel_logs JOIN {_VK} USING (vehicle_id)""",
)
def _(t):
    return marts.fact_fuel(t["fuel_logs"], vehicle_dim(t))


@query(
    "fact_maintenance",
    f"""SELECT maint_id, vehicle_key, {_KEY.format(c='maintenance_date')} AS date_key, {_KEY.format(c='next_due_date')} AS due_date_key, maintenance_type, total_cost, status = 'Scheduled' AS is_scheduled
        FROM maintenance JOIN {_VK} USING (vehicle_id)""",
)
def _(t):
    return marts.fact_maintenance(t["maintenance"], vehicle_dim(t))


@query(
    "mart_daily_revenue",
    f"SELECT date_key, COUNT(*) AS trips, {CI('is_cancelled')} AS cancelled, {SI('is_completed', 'trip_fare')} AS revenue FROM {_FACT} GROUP BY 1",
)
def _(t):
    return marts.daily_revenue(fact_trips(t))


def _pnl_month_sql():
    parts = {
        "revenue": f"SELECT fleet_id, {M('invoice_date')} AS month, {S('total_amount')} AS revenue FROM fleet_invoices GROUP BY 1, 2",
        "fuel_cost": f"SELECT fleet_id, {M('fill_date')} AS month, {S('fuel_cost')} AS fuel_cost FROM fuel_logs JOIN driver_fleet USING (driver_id) GROUP BY 1, 2",
        "maint_cost": f"SELECT fleet_id, {M('maintenance_date')} AS month, {S('total_cost')} AS maint_cost FROM maintenance JOIN driver_fleet USING (driver_id) GROUP BY 1, 2",
        "opex": f"SELECT fleet_id, expense_month AS month, {S('amount')} AS opex FROM opex JOIN customer_fleet USING (customer_id) GROUP BY 1, 2",
    }
    joined = " FULL JOIN ".join(f"({q}) USING (fleet_id, month)" if i else f"({q})" for i, q in enumerate(parts.values()))
    cols = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in parts)
    return f"SELECT fleet_id, {D('month')} AS month, revenue, fuel_cost, maint_cost, opex, revenue - fuel_cost - maint_cost - opex AS net FROM (SELECT fleet_id, month, {cols} FROM {joined})"


def fleet_months(t):
    def per(df, member, fleet_view, date, amount, name):
        small = df.groupBy(member, F.trunc(date, "month").alias("month")).agg(fn.msum(amount).alias("_s"))
        return small.join(t[fleet_view], member).groupBy("fleet_id", "month").agg(F.sum("_s").cast("double").alias(name))

    return (
        per(t["invoices"], "customer_id", "customer_fleet", "invoice_date", "total_amount", "revenue"),
        per(t["fuel_logs"], "driver_id", "driver_fleet", "fill_date", "fuel_cost", "fuel_cost"),
        per(t["maintenance"], "driver_id", "driver_fleet", "maintenance_date", "total_cost", "maint_cost"),
        per(t["opex"], "customer_id", "customer_fleet", "expense_month", "amount", "opex"),
    )


@query("mart_monthly_fleet_pnl", _pnl_month_sql())
def _(t):
    return marts.monthly_fleet_pnl(*fleet_months(t))


@query(
    "mart_customer_ltv",
    f"""SELECT customer_id, total_invoices, total_spend, avg_order_value, total_paid, {D('first_purchase')} AS first_purchase, {D('last_purchase')} AS last_purchase, customer_age_days,
        RANK() OVER (ORDER BY total_spend DESC) AS ltv_rank, NTILE(5) OVER (ORDER BY total_spend DESC, customer_id) AS ltv_quintile, total_spend / NULLIF(customer_age_days, 0) * 365 AS annualised_spend FROM (
        SELECT customer_id, COUNT(*) AS total_invoices, {S('total_amount')} AS total_spend, {A('total_amount')} AS avg_order_value, {S('paid_amount')} AS total_paid, MIN(invoice_date) AS first_purchase,
        MAX(invoice_date) AS last_purchase, DATE_DIFF('day', MIN(invoice_date), MAX(invoice_date)) AS customer_age_days FROM invoices GROUP BY 1)""",
)
def _(t):
    return marts.customer_ltv(t["invoices"])


@query(
    "mart_vehicle_utilization",
    f"""SELECT vehicle_key, {D('month')} AS month, trips, days_used, revenue, GREATEST(0.0::DOUBLE, LEAST(100.0::DOUBLE, days_used / 30 * 100)) AS utilisation_pct FROM (
        SELECT vehicle_key, {M('trip_date')} AS month, COUNT(*) AS trips, {S('duration_days')} AS days_used, {S('trip_fare')} AS revenue FROM {_FACT} WHERE is_completed GROUP BY 1, 2)""",
)
def _(t):
    return marts.vehicle_utilization(fact_trips(t))


@query(
    "mart_driver_scorecard",
    f"""SELECT driver_id, COUNT(*) AS trips, {A('safety_score')} AS avg_score, AVG(rating) AS avg_rating, {CI('accident')} AS accidents, {CI('complaint')} AS complaints FROM telematics GROUP BY 1""",
)
def _(t):
    return marts.driver_scorecard(marts.fact_telematics(t["telematics"]))


@query(
    "export_marts",
    f"""SELECT 'customer_ltv' AS step, 'ok' AS status, COUNT(DISTINCT customer_id) AS row_count FROM invoices UNION ALL SELECT 'driver_scorecard', 'ok', COUNT(DISTINCT driver_id) FROM telematics
        UNION ALL SELECT 'missing_mart', 'failed', NULL""",
)
def _(t):
    root = scratch_path(t.spark, "marts")
    exports = {
        "customer_ltv": lambda: marts.customer_ltv(t["invoices"]),
        "missing_mart": lambda: t.spark.read.parquet(f"{root}/absent"),
        "driver_scorecard": lambda: marts.driver_scorecard(marts.fact_telematics(t["telematics"])),
    }
    return sinks.export_marts(t.spark, exports, root).select("step", "status", "row_count")


def full_load(t, root):
    """All warehouse steps in order, each written below ``root``; returns the audit rows."""
    spark = t.spark

    def save(name, df, month_of=None):
        path = f"{root}/{name}"
        if month_of:
            load.write_months(df, path, month_of)
        else:
            df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path).agg(rows()).first()[0]

    def stored(name):
        return spark.read.parquet(f"{root}/{name}")

    def trips():
        staged, orders = t["staged_trips"], t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("booking_datetime"))
        return marts.fact_trips(staged.join(orders, "l_orderkey"), stored("dim_vehicle"), stored("dim_driver"))

    return sinks.run_steps(
        spark,
        {
            "dim_date": lambda: save("dim_date", dims.dim_date(t["orders"], "o_orderdate", HOLIDAYS)),
            "dim_customer": lambda: save("dim_customer", customer_scd2(t)),
            "dim_vehicle": lambda: save("dim_vehicle", vehicle_dim(t)),
            "dim_driver": lambda: save("dim_driver", driver_dim(t)),
            "fact_trips": lambda: save("fact_trips", trips(), "trip_date"),
            "fact_invoices": lambda: save("fact_invoices", marts.fact_invoices(t["invoices"]), "invoice_date"),
            "mart_daily_revenue": lambda: save("mart_daily_revenue", marts.daily_revenue(stored("fact_trips"))),
            "mart_vehicle_utilization": lambda: save("mart_vehicle_utilization", marts.vehicle_utilization(stored("fact_trips"))),
        },
    )


_FULL_LOAD = f"""SELECT 'dim_date' AS step, 'ok' AS status, CAST(DATE_DIFF('day', MIN(o_orderdate), MAX(o_orderdate)) + 1 AS BIGINT) AS row_count FROM orders UNION ALL SELECT 'dim_customer', 'ok', COUNT(*) FROM ({_SCD2})
        UNION ALL SELECT 'dim_vehicle', 'ok', COUNT(*) + 1 FROM part UNION ALL SELECT 'dim_driver', 'ok', COUNT(*) + 1 FROM supplier UNION ALL SELECT 'fact_trips', 'ok', COUNT(*) FROM staged_lineitem
        UNION ALL SELECT 'fact_invoices', 'ok', COUNT(*) FROM orders UNION ALL SELECT 'mart_daily_revenue', 'ok', COUNT(DISTINCT CAST(l_shipdate AS DATE)) FROM staged_lineitem
        UNION ALL SELECT 'mart_vehicle_utilization', 'ok', COUNT(*) FROM (SELECT DISTINCT vehicle_id, {M('pickup_datetime')} FROM staged_trips WHERE {DONE})"""


@query(
    "full_load",
    _FULL_LOAD,
)
def _(t):
    return full_load(t, scratch_path(t.spark, "warehouse")).select("step", "status", "row_count")


@query("load_audit", f"SELECT step, status, row_count, TRUE AS timed, CAST(NULL AS VARCHAR) AS message FROM ({_FULL_LOAD})")
def _(t):
    # the audit table is written and read back; run times differ, so only their presence is compared
    path = scratch_path(t.spark, "audit")
    full_load(t, scratch_path(t.spark, "warehouse")).write.parquet(path)
    return t.spark.read.parquet(path).select("step", "status", "row_count", (F.col("seconds") > 0).alias("timed"), "message")


@query(
    "incremental_load",
    f"""WITH late AS (SELECT MAX(invoice_date) AS seen FROM invoices WHERE invoice_date < DATE '{CUTOFF}')
        SELECT invoice_id, customer_id, CAST(CASE WHEN invoice_date >= seen AND invoice_id % 5 = 0 THEN invoice_date + 45 ELSE invoice_date END AS VARCHAR) AS invoice_date,
            total_amount + CASE WHEN invoice_date >= seen THEN 1 ELSE 0 END AS total_amount FROM invoices, late""",
)
def _(t):
    root = incremental(t)
    return snapshots.read(t.spark, f"{root}/fact_invoices")


def incremental(t):
    """First load: everything, with the late months still open; second run: rows from the watermark on, those of its own day included, and every fifth of them moved into another month."""
    root = scratch_path(t.spark, "incremental")
    inv = t["invoices"].select("invoice_id", "customer_id", "invoice_date", "total_amount")
    cutoff = F.lit(CUTOFF).cast("date")
    snapshots.create(inv.where(F.col("invoice_date") < F.add_months(cutoff, 3)), f"{root}/fact_invoices", "invoice_date", ["invoice_id"], buckets=8)
    load.measure_state({"fact_invoices": (inv.where(F.col("invoice_date") < cutoff), "invoice_date")}).write.parquet(f"{root}/state")
    late = inv.withColumn("total_amount", F.col("total_amount") + 1)
    delta = load.after_watermark(late, "invoice_date", load.read_state(t.spark, f"{root}/state"), "fact_invoices")
    moved = F.when(F.col("invoice_id") % 5 == 0, F.date_add("invoice_date", 45)).otherwise(F.col("invoice_date"))
    snapshots.merge(delta.withColumn("invoice_date", moved), f"{root}/fact_invoices", run="second")
    return root


_SEEN = f"""late AS (SELECT MAX(invoice_date) AS seen FROM invoices WHERE invoice_date < DATE '{CUTOFF}'),
    first AS (SELECT invoice_id, invoice_date FROM invoices WHERE invoice_date < DATE '{CUTOFF}' + INTERVAL 3 MONTH),
    moved AS (SELECT invoice_id, CAST(CASE WHEN invoice_id % 5 = 0 THEN invoice_date + 45 ELSE invoice_date END AS DATE) AS invoice_date FROM invoices, late WHERE invoice_date >= seen),
    second AS (SELECT * FROM moved UNION ALL SELECT * FROM first WHERE invoice_id NOT IN (SELECT invoice_id FROM moved)),
    touched AS (SELECT STRFTIME(invoice_date, '%Y-%m') AS m FROM moved UNION SELECT STRFTIME(invoice_date, '%Y-%m') FROM first WHERE invoice_id IN (SELECT invoice_id FROM moved))"""


@query(
    "snapshot_versions",
    f"""WITH {_SEEN} SELECT 1 AS version, STRFTIME(invoice_date, '%Y-%m') AS month_key, COUNT(*) AS row_count, TRUE AS rewritten FROM first GROUP BY 2
        UNION ALL SELECT 2, STRFTIME(invoice_date, '%Y-%m'), COUNT(*), STRFTIME(invoice_date, '%Y-%m') IN (SELECT m FROM touched) FROM second GROUP BY 2""",
)
def _(t):
    path = f"{incremental(t)}/fact_invoices"
    made = [(v, m) for v in snapshots.versions(t.spark, path) for m in snapshots.manifest(t.spark, path, v)["touched"]]
    rewritten = t.spark.createDataFrame(made, "version int, month_key string").withColumn("rewritten", F.lit(True))
    counts = snapshots.row_counts(t.spark, path)
    return counts.join(rewritten, ["version", "month_key"], "left").select("version", "month_key", "row_count", F.coalesce("rewritten", F.lit(False)).alias("rewritten"))


@query(
    "snapshot_key_months",
    f"""WITH {_SEEN} SELECT invoice_id, STRFTIME(invoice_date, '%Y-%m') AS month_key FROM second WHERE invoice_id IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUTOFF}')""",
)
def _(t):
    # the month of the invoices of late shipments, from the key index: no invoice is read
    path = f"{incremental(t)}/fact_invoices"
    wanted = t["lineitem"].where(F.col("l_shipdate") >= F.lit(CUTOFF).cast("timestamp")).select(F.col("l_orderkey").alias("invoice_id"))
    return snapshots.find(t.spark, path, wanted).select("invoice_id", "month_key")


def _loaded_state(t):
    """State as of a load that ended before the cut-off date."""
    o = t["orders"].where(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp"))
    e = t["events"].where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return load.measure_state({"orders": (o, "o_orderdate"), "events": (e, "ts")})


@query(
    "detect_new_rows",
    f"""SELECT 'orders' AS table_name, COUNT(*) AS row_count, {CI(f"o_orderdate < TIMESTAMP '{CUTOFF}'")} AS loaded, {CI(f"o_orderdate >= TIMESTAMP '{CUTOFF}'")} AS new_rows, 'incremental load' AS action FROM orders
        UNION ALL SELECT 'events', COUNT(*), {CI("ts < TIMESTAMP '2024-01-20'")}, {CI("ts >= TIMESTAMP '2024-01-20'")}, 'incremental load' FROM events
        UNION ALL SELECT 'lineitem', COUNT(*), 0, COUNT(*), 'full load' FROM lineitem""",
)
def _(t):
    current = load.measure_state({"orders": (t["orders"], "o_orderdate"), "events": (t["events"], "ts"), "lineitem": (t["lineitem"], "l_shipdate")})
    return load.detect_new_rows(current, _loaded_state(t))


@query("watermark_filter", "SELECT event_id, user_id, event_type FROM events WHERE ts >= (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def _(t):
    return load.after_watermark(t["events"], "ts", _loaded_state(t), "events").select("event_id", "user_id", "event_type")


@query("input_inventory", "SELECT 'lineitem.parquet' AS file_name, COUNT(*) AS row_count, 'parquet' AS kind FROM lineitem UNION ALL SELECT 'orders.parquet', COUNT(*), 'parquet' FROM orders")
def _(t):
    return union_all(load.input_inventory(t["lineitem"]), load.input_inventory(t["orders"])).drop("file_size")


@query("archive_manifest", "SELECT 'events.parquet' AS file_name, COUNT(*) AS row_count, 'parquet' AS kind, 'run-1' AS run_id, 'processed' AS state FROM events")
def _(t):
    return load.run_manifest(t["events"], "run-1").drop("file_size")


def lineage_edges(t):
    """Derivation edges between the members of the tables, from their keys."""

    def node(prefix, c):
        return F.concat(F.lit(f"{prefix}:"), F.col(c))

    return union_all(
        t["nation"].select(node("region", "n_regionkey").alias("source"), node("nation", "n_nationkey").alias("target")),
        t["customer"].select(node("nation", "c_nationkey").alias("source"), node("customer", "c_custkey").alias("target")),
        t["orders"].select(node("customer", "o_custkey").alias("source"), node("order", "o_orderkey").alias("target")),
    )


@query(
    "lineage_closure",
    """WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1), c AS (SELECT c_custkey FROM customer JOIN n ON c_nationkey = n_nationkey)
        SELECT 'nation:' || n_nationkey AS node, 1 AS depth FROM n UNION ALL SELECT 'customer:' || c_custkey, 2 FROM c
        UNION ALL SELECT 'order:' || o_orderkey, 3 FROM orders JOIN c ON o_custkey = c_custkey""",
)
def _(t):
    start = t["region"].where(F.col("r_regionkey") == 1).select(F.concat(F.lit("region:"), "r_regionkey").alias("node"))
    return load.lineage(lineage_edges(t), start)


@query(
    "order_chains",
    """SELECT 'order:' || o_orderkey AS node, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS depth FROM orders QUALIFY depth > 0""",
)
def _(t):
    # every order leads to the customer's next one; a chain of n orders is followed in about log2(n) rounds
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    orders = t["orders"].select(F.concat(F.lit("order:"), "o_orderkey").alias("source"), F.concat(F.lit("order:"), F.lead("o_orderkey").over(w)).alias("target"), F.row_number().over(w).alias("n"))
    return load.lineage(orders, orders.where("n = 1").select(F.col("source").alias("node")))


@query(
    "lineage_upstream",
    """WITH o AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 490000), c AS (SELECT DISTINCT c_custkey, c_nationkey FROM customer JOIN o ON c_custkey = o_custkey)
        SELECT 'customer:' || o_custkey AS node, 1 AS depth FROM o UNION ALL SELECT DISTINCT 'nation:' || c_nationkey, 2 FROM c
        UNION ALL SELECT DISTINCT 'region:' || n_regionkey, 3 FROM c JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    start = t["orders"].where(F.col("o_totalprice") > 490_000).select(F.concat(F.lit("order:"), "o_orderkey").alias("node"))
    return load.lineage(lineage_edges(t), start, downstream=False)


@query("eav_pivot", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def _(t):
    p = t["part"]
    attrs = ["p_name", "p_brand", "p_size", "p_retailprice"]
    long = p.select("p_partkey", *[F.col(c).cast("string").alias(c) for c in attrs]).unpivot(["p_partkey"], attrs, "attr_name", "attr_value")
    return load.eav_pivot(long, "p_partkey", {"p_name": "string", "p_brand": "string", "p_size": "int", "p_retailprice": "double"})


# --- business rules ---


def billed_events(t):
    """Events as trips: a type of them are airport transfers, the value is the fare basis."""
    e = t["events"]
    trips = e.select(
        F.col("event_id").alias("trip_id"), F.col("user_id").alias("customer_id"), F.col("ts").alias("pickup"), (fn.money("value") * 100).cast("double").alias("base_fare"),
        F.when(F.col("event_type") == "signup", "Airport Transfer").otherwise("City Ride").alias("booking_type"),
    )
    share = F.when(F.col("customer_id") % 4 == 0, F.lit(0.5)).when(F.col("customer_id") % 4 == 1, F.lit(0.0)).otherwise(F.lit(1.0))
    discount = F.when(F.col("base_fare") > 5000, F.lit(250.0)).otherwise(F.lit(0.0))
    return rules.derive_invoice(trips, 4000.0, share, discount)


_BILLED = """(SELECT *, CAST(ROUND(total * share, 2) AS DECIMAL(18,4)) AS paid FROM (SELECT *, base + airport + night - discount AS total FROM (
    SELECT event_id AS trip_id, user_id AS customer_id, ts, CAST(CAST(value AS DECIMAL(18,4)) * 100 AS DECIMAL(18,4)) AS base, CAST(CASE WHEN event_type = 'signup' THEN 4000 ELSE 0 END AS DECIMAL(18,4)) AS airport,
    CAST(CASE WHEN EXTRACT(hour FROM ts) >= 22 OR EXTRACT(hour FROM ts) < 6 THEN ROUND(CAST(CAST(value AS DECIMAL(18,4)) * 10 AS DECIMAL(18,4)), 0) ELSE 0 END AS DECIMAL(18,4)) AS night,
    CAST(CASE WHEN CAST(value AS DECIMAL(18,4)) * 100 > 5000 THEN 250 ELSE 0 END AS DECIMAL(18,4)) AS discount, CAST(CASE user_id % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 0 ELSE 1 END AS DECIMAL(5,4)) AS share FROM events)))"""


@query(
    "derive_invoice",
    f"""SELECT trip_id, customer_id, base::DOUBLE AS base_fare, airport::DOUBLE AS airport_surcharge, night::DOUBLE AS night_surcharge, discount::DOUBLE AS discount, total::DOUBLE AS total, paid::DOUBLE AS paid,
        (total - paid)::DOUBLE AS outstanding, CASE WHEN total - paid = 0 THEN 'Paid' WHEN paid > 0 THEN 'Partial' ELSE 'Unpaid' END AS payment_status, {D('ts')} AS invoice_date,
        {D('ts::DATE + 7')} AS due_date FROM {_BILLED}""",
)
def _(t):
    return billed_events(t).drop("pickup", "booking_type")


@query(
    "derive_line_items",
    f"""SELECT trip_id, 'Base Rental Fare' AS charge_type, 'Base fare' AS description, base::DOUBLE AS amount FROM {_BILLED} UNION ALL SELECT trip_id, 'Surcharge', 'Airport Pickup/Drop', airport::DOUBLE FROM {_BILLED} WHERE airport > 0
        UNION ALL SELECT trip_id, 'Surcharge', 'Night Surcharge', night::DOUBLE FROM {_BILLED} WHERE night > 0 UNION ALL SELECT trip_id, 'Discount', 'Promotional / Loyalty Discount', -discount::DOUBLE FROM {_BILLED} WHERE discount > 0""",
)
def _(t):
    return rules.derive_line_items(billed_events(t))


def _legs_number(c):
    return F.least(F.lit(5), F.greatest(F.lit(2), F.ceil(c / 125).cast("int")))


@query(
    "derive_legs",
    """WITH x AS (SELECT trip_id, distance_km, 24.0::DOUBLE + a.n_nationkey * 0.4::DOUBLE AS lat1, 24.0::DOUBLE + b.n_nationkey * 0.4::DOUBLE AS lat2, 66.0::DOUBLE + a.n_nationkey * 0.3::DOUBLE AS lon1,
            66.0::DOUBLE + b.n_nationkey * 0.3::DOUBLE AS lon2, LEAST(5, GREATEST(2, CAST(CEIL(distance_km / 125) AS INTEGER))) AS n FROM routed_trips
            JOIN nation a ON pickup_city = a.n_name JOIN nation b ON dropoff_city = b.n_name WHERE distance_km > 100 AND pickup_city <> dropoff_city),
        y AS (SELECT *, CAST(UNNEST(GENERATE_SERIES(1, n)) AS INTEGER) AS leg FROM x)
        SELECT leg AS leg_sequence, 'Waypoint-' || leg AS city, COUNT(*) AS legs, COUNT(DISTINCT trip_id) AS trips, ROUND(MIN(lat1 + (lat2 - lat1) * (leg / n)), 6) AS south, ROUND(MAX(lon1 + (lon2 - lon1) * (leg / n)), 6) AS east,
            CAST(SUM(CAST(ROUND(CAST(distance_km / n * leg AS DECIMAL(18,6)), 1) AS DECIMAL(18,4))) AS DOUBLE) AS km FROM y GROUP BY 1, 2""",
)
def _(t):
    legs = trip_legs(t)
    return legs.groupBy("leg_sequence", "city").agg(
        rows().alias("legs"), F.count_distinct("trip_id").alias("trips"), F.min("lat").alias("south"), F.max("lon").alias("east"), dsum("km_so_far").alias("km")
    )


def trip_legs(t):
    places = t["nation"].select("n_name", (24.0 + F.col("n_nationkey") * 0.4).alias("lat"), (66.0 + F.col("n_nationkey") * 0.3).alias("lon"))
    a = places.select(F.col("n_name").alias("pickup_city"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = places.select(F.col("n_name").alias("dropoff_city"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    trips = t["routed_trips"].where(F.col("pickup_city") != F.col("dropoff_city")).join(a, "pickup_city").join(b, "dropoff_city")
    return rules.derive_legs(trips, _legs_number(F.col("distance_km")))


@query(
    "safety_score",
    "SELECT telem_id, ROUND(GREATEST(0, LEAST(100, 100 - harsh_brakes * 1.5 - harsh_accels - idle_minutes * 0.05 - speeding_km * 0.3)), 6) AS score FROM telematics",
)
def _(t):
    s = rules.safety_score(F.col("harsh_brakes"), F.col("harsh_accels"), F.col("idle_minutes"), F.col("speeding_km"))
    return t["telematics"].select("telem_id", F.round(s, 6).alias("score"))


# the fixed price timeline moved into the years of the sample orders
SHIFTED_PRICES = [(f"{int(d[:4]) - 26}{d[4:]}", *prices) for d, *prices in FUEL_PRICE_TIMELINE]


@query(
    "fuel_cost",
    f"""SELECT fuel_id, vehicle_id, fuel_type, price, CAST(CAST(litres AS DECIMAL(18,4)) * CAST(price AS DECIMAL(8,2)) AS DOUBLE) AS cost, km_driven / litres AS km_per_litre FROM (SELECT *, CASE fuel_type
        WHEN 'Diesel' THEN {_steps_sql([(r[0], r[2]) for r in SHIFTED_PRICES], 'fill_date', 220.0)} WHEN 'CNG' THEN {_steps_sql([(r[0], r[3]) for r in SHIFTED_PRICES], 'fill_date', 220.0)}
        ELSE {_steps_sql([(r[0], r[1]) for r in SHIFTED_PRICES], 'fill_date', 220.0)} END AS price FROM fuel_logs)""",
)
def _(t):
    price = rules.fuel_price(F.col("fuel_type"), F.col("fill_date"), SHIFTED_PRICES)
    df = t["fuel_logs"].withColumn("price", price)
    cost = (fn.money("litres") * F.col("price").cast("decimal(8,2)")).cast("double")
    return df.select("fuel_id", "vehicle_id", "fuel_type", "price", cost.alias("cost"), fn.ratio("km_driven", "litres").alias("km_per_litre"))


@query(
    "expense_spine",
    f"""WITH m AS (SELECT DISTINCT {M('o_orderdate')} AS month FROM orders), b AS (SELECT nation_id, SUM(salary) AS base FROM drivers GROUP BY 1),
        s(category, share) AS (VALUES {", ".join(f"('{c}', CAST({v} AS DECIMAL(4,2)))" for c, v in EXPENSE_SHARES.items())})
        SELECT {D('month')} AS month, nation_id, category, CAST(CAST(base AS DECIMAL(18,4)) * share AS DOUBLE) AS amount FROM m, b, s""",
)
def _(t):
    bases = t["drivers"].groupBy("nation_id").agg(F.sum("salary").alias("base"))
    return rules.expense_spine(joins.month_spine(t["orders"], "o_orderdate"), bases, "nation_id")


@query(
    "rate_matrix",
    f"""WITH ty AS (SELECT p_type AS category, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS daily_rate FROM part GROUP BY 1),
        bk(booking_type, factor) AS (VALUES {", ".join(f"('{b}', CAST({m} AS DECIMAL(4,2)))" for b, m in BOOKING_MULTIPLIERS.items())})
        SELECT fleet_id, fleet_name, category, booking_type, CAST(ROUND(CAST(daily_rate AS DECIMAL(18,4)) * factor, 0) AS DOUBLE) AS daily_rate, '1995-01-01' AS effective_from, '2001-12-31' AS effective_to FROM fleets, ty, bk""",
)
def _(t):
    types = t["part"].groupBy(F.col("p_type").alias("category")).agg(fn.davg("p_retailprice").alias("daily_rate"))
    return rules.rate_matrix(t["fleets"], types, "1995-01-01", "2001-12-31")


@query(
    "pricing_fare",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 45 THEN ROUND(CAST(p_retailprice * 28 * 0.75 AS DECIMAL(18,6)), 0) ELSE ROUND(CAST(p_retailprice * (l_quantity / 10) + l_quantity * 10 * 12.0 AS DECIMAL(18,6)), 0) END::DOUBLE AS fare
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _(t):
    df = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    q = F.col("l_quantity")
    fare = rules.trip_fare(F.col("p_retailprice"), q / 10, q * 10, F.lit(12.0), q > 45)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", fare.alias("fare"))
