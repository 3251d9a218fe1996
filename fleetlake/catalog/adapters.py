"""The sample tables seen as a rental business.

Each view exists twice: as a DataFrame (what the queries run on) and as SQL text (a CTE
of the checking SQL). Views carry only the joins their columns need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.constants import PROFILES
from fleetlake.operators.sets import dedup_latest
from fleetlake.session import tune
from fleetlake.sources.tables import load_table

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
FOREIGN_KEYS = {
    "nation": ["n_regionkey"], "customer": ["c_nationkey"], "supplier": ["s_nationkey"], "orders": ["o_custkey"],
    "lineitem": ["l_partkey", "l_suppkey"], "labels": ["doc_id"],
}

AS_OF = "2001-08-01"
EVENT_AS_OF = "2024-02-01"

_LI_REST = [
    "-l_partkey", "-l_suppkey", "-l_quantity", "-l_extendedprice", "-l_discount", "-l_tax", "-l_returnflag",
    "-l_linestatus",
]


def profile_of(c: Column) -> Column:
    """Behaviour profile of a driver number."""
    return F.element_at(F.array(*[F.lit(p) for p in PROFILES]), (c % 5 + 1).cast("int"))


def _profile_sql(c: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PROFILES))
    return f"CASE {c} % 5 {cases} END"


def _cents(c: str) -> Column:
    """Whole hundredths; products of them are exact in doubles."""
    return F.rint(F.col(c) * 100)


class Tables:
    """Sample tables and views of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = tune(spark)
        self.root = root
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            build = _VIEWS.get(name)
            self._cache[name] = build(self) if build else load_table(self.spark, self.root, name)
        return self._cache[name]


def _trip_columns(li: DataFrame) -> DataFrame:
    return li.select(
        "l_orderkey",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        F.col("l_partkey").alias("vehicle_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.expr("l_shipdate + l_quantity * INTERVAL '1' HOUR").alias("dropoff_datetime"),
        (F.col("l_quantity") / 10).alias("duration_days"),
        (F.col("l_quantity") * 10).alias("distance_km"),
        (_cents("l_extendedprice") * (100 - _cents("l_discount")) / 10_000).alias("trip_fare"),
        F.when(F.col("l_returnflag") == "R", "Cancelled").otherwise("Completed").alias("status"),
        (F.col("l_linestatus") == "F").alias("with_driver"),
    )


_TRIP_SQL = """SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS trip_id, l_partkey AS vehicle_id,
    l_suppkey AS driver_id, l_shipdate AS pickup_datetime, l_shipdate + l_quantity * INTERVAL '1' HOUR AS dropoff_datetime,
    l_quantity / 10 AS duration_days, l_quantity * 10 AS distance_km,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS trip_fare,
    CASE WHEN l_returnflag = 'R' THEN 'Cancelled' ELSE 'Completed' END AS status,
    l_linestatus = 'F' AS with_driver FROM """


def _booked(trips: DataFrame, t: Tables) -> DataFrame:
    o = t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("booking_type"),
        F.col("o_orderdate").alias("booking_datetime"),
    )
    return trips.join(o, "l_orderkey")


def _supplier_city(t: Tables) -> DataFrame:
    s = t["supplier"].select(F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").alias("n_nationkey"))
    return s.join(t["nation"], "n_nationkey").select("driver_id", F.col("n_name").alias("pickup_city"))


def _customer_city(t: Tables) -> DataFrame:
    c = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("n_nationkey"))
    return c.join(t["nation"], "n_nationkey").select("customer_id", F.col("n_name").alias("dropoff_city"))


def _staged_lineitem(t: Tables) -> DataFrame:
    return dedup_latest(t["lineitem"], ["l_orderkey", "l_linenumber"], ["-l_shipdate", *_LI_REST])


def _invoices(t: Tables) -> DataFrame:
    total, zero = F.col("o_totalprice"), F.lit(0.0)
    status = F.col("o_orderstatus")
    paid = F.when(status == "F", total).when(status == "P", total * 0.5).otherwise(zero)
    owed = F.when(status == "F", zero).when(status == "P", total * 0.5).otherwise(total)
    return t["orders"].select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("invoice_date"),
        F.date_add(F.to_date("o_orderdate"), 7).alias("due_date"),
        F.col("o_totalprice").alias("total_amount"),
        paid.alias("paid_amount"),
        owed.alias("outstanding"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(status == "F", "Paid").when(status == "P", "Partial").otherwise("Unpaid").alias("payment_status"),
    )


def _fleet_of_customer(t: Tables) -> DataFrame:
    c = t["customer"].select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("n_nationkey"))
    n = t["nation"].select("n_nationkey", F.col("n_regionkey").alias("fleet_id"))
    return c.join(n, "n_nationkey").select("customer_id", "fleet_id")


def _fleet_of_driver(t: Tables) -> DataFrame:
    s = t["supplier"].select(F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").alias("n_nationkey"))
    n = t["nation"].select("n_nationkey", F.col("n_regionkey").alias("fleet_id"))
    return s.join(n, "n_nationkey").select("driver_id", "fleet_id")


def _telematics(t: Tables) -> DataFrame:
    brake, accel, idle = F.col("event_id") % 3, F.col("event_id") % 2, F.col("event_id") % 60
    # in ten-thousandths of a point: 1.5, 1, 0.05 and 0.3 per half unit of value
    penalty = brake * 15_000 + accel * 10_000 + idle * 500 + _cents("value") * 15
    score = F.greatest(F.lit(0.0), F.least(F.lit(1_000_000.0), 1_000_000 - penalty)) / 10_000
    return t["events"].select(
        F.col("event_id").alias("telem_id"),
        F.col("user_id").alias("driver_id"),
        F.col("ts").alias("trip_date"),
        brake.alias("harsh_brakes"),
        accel.alias("harsh_accels"),
        idle.alias("idle_minutes"),
        (F.col("value") / 2).alias("speeding_km"),
        F.col("value").alias("distance_km"),
        (F.col("event_id") % 90 + 10).alias("duration_min"),
        (F.col("event_id") % 80 + 40).alias("max_speed"),
        (F.col("value") * 60 / (F.col("event_id") % 90 + 10)).alias("mean_speed"),
        score.alias("safety_score"),
        (F.col("event_type") == "error").alias("accident"),
        (F.col("event_type") == "signup").alias("complaint"),
        (F.col("event_id") % 5 + 1).cast("bigint").alias("rating"),
        "event_type",
    )


def _vehicles(t: Tables) -> DataFrame:
    status = F.col("p_partkey") % 10
    return t["part"].select(
        F.col("p_partkey").alias("vehicle_id"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("model"),
        (2001 - F.col("p_size") % 15).alias("year"),
        (F.col("p_size") * 1000).alias("odometer_km"),
        F.col("p_retailprice").alias("daily_rate"),
        F.expr("DATE '2001-01-01' + p_size * INTERVAL '10' DAY").cast("date").alias("insurance_expiry"),
        F.expr("DATE '2001-03-01' + p_size * INTERVAL '7' DAY").cast("date").alias("fitness_expiry"),
        F.when(status < 6, "Available").when(status < 8, "On Trip").when(status < 9, "Maintenance")
        .otherwise("Retired").alias("status"),
    )


def _drivers(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t["supplier"].select(
        k.alias("driver_id"),
        F.col("s_name").alias("full_name"),
        F.col("s_nationkey").alias("nation_id"),
        profile_of(k).alias("profile"),
        (30000 + 10 * (k % 50)).alias("salary"),
        (k % 10 / 100).alias("brake_rate"),
        (k % 7 / 100).alias("accel_rate"),
        (k % 5 / 10).alias("idle_rate"),
        (k % 4 / 10).alias("speeding_rate"),
        F.expr("DATE '2001-03-01' + CAST(s_suppkey % 300 AS INT) * INTERVAL '1' DAY").cast("date").alias("license_expiry"),
    )


def _maintenance(t: Tables) -> DataFrame:
    return _maintenance_columns(t["lineitem"])


def _maintenance_columns(li: DataFrame) -> DataFrame:
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("maint_id"),
        F.col("l_partkey").alias("vehicle_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.concat("l_returnflag", "l_linestatus").alias("maintenance_type"),
        F.to_date("l_shipdate").alias("maintenance_date"),
        (_cents("l_extendedprice") * _cents("l_tax") / 10_000).alias("total_cost"),
        F.when(F.col("l_linestatus") == "O", "Scheduled").otherwise("Completed").alias("status"),
        F.date_add(F.to_date("l_shipdate"), 90).alias("next_due_date"),
    )


_MAINT_SQL = """SELECT l_orderkey * 10 + l_linenumber AS maint_id, l_partkey AS vehicle_id, l_suppkey AS driver_id,
    l_returnflag || l_linestatus AS maintenance_type, CAST(l_shipdate AS DATE) AS maintenance_date,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE) AS total_cost,
    CASE WHEN l_linestatus = 'O' THEN 'Scheduled' ELSE 'Completed' END AS status,
    CAST(l_shipdate + INTERVAL 90 DAY AS DATE) AS next_due_date FROM """


def _fuel(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fuel_id"),
        F.col("l_partkey").alias("vehicle_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.to_date("l_shipdate").alias("fill_date"),
        F.when(flag == "A", "Petrol").when(flag == "N", "Diesel").otherwise("CNG").alias("fuel_type"),
        F.col("l_quantity").alias("litres"),
        (F.col("l_quantity") * 10).alias("km_driven"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity")) / 100).alias("efficiency"),
        (_cents("l_extendedprice") / 1_000).alias("fuel_cost"),
    )


def _opex(t: Tables) -> DataFrame:
    return t["orders"].select(
        F.col("o_orderkey").alias("expense_id"),
        F.col("o_custkey").alias("customer_id"),
        F.trunc("o_orderdate", "month").alias("expense_month"),
        F.col("o_orderpriority").alias("category"),
        (_cents("o_totalprice") * 5 / 10_000).alias("amount"),
    )


def _customers(t: Tables) -> DataFrame:
    return t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("customer_type"),
        F.col("n_name").alias("city"),
    )


_VIEWS = {
    "staged_lineitem": _staged_lineitem,
    "trips": lambda t: _trip_columns(t["lineitem"]),
    "staged_trips": lambda t: _trip_columns(t["staged_lineitem"]),
    "booked_trips": lambda t: _booked(t["trips"], t),
    "city_trips": lambda t: t["trips"].join(_supplier_city(t), "driver_id"),
    "routed_trips": lambda t: t["booked_trips"].join(_supplier_city(t), "driver_id").join(_customer_city(t), "customer_id"),
    "invoices": _invoices,
    "fleet_invoices": lambda t: t["invoices"].join(_fleet_of_customer(t), "customer_id"),
    "fleets": lambda t: t["region"].select(F.col("r_regionkey").alias("fleet_id"), F.col("r_name").alias("fleet_name")),
    "customer_fleet": _fleet_of_customer,
    "driver_fleet": _fleet_of_driver,
    "customers": _customers,
    "vehicles": _vehicles,
    "drivers": _drivers,
    "telematics": _telematics,
    "telem_drivers": lambda t: t["events"].select(F.col("user_id").alias("driver_id")).distinct()
    .select("driver_id", profile_of(F.col("driver_id")).alias("profile")),
    "maintenance": _maintenance,
    "staged_maintenance": lambda t: _maintenance_columns(t["staged_lineitem"]),
    "fuel_logs": _fuel,
    "opex": _opex,
}

VIEW_SQL = {
    "staged_lineitem": """SELECT * EXCLUDE (rn_) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
        l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn_ FROM lineitem) WHERE rn_ = 1""",
    "trips": _TRIP_SQL + "lineitem",
    "staged_trips": _TRIP_SQL + "staged_lineitem",
    "booked_trips": """SELECT tr.*, o_custkey AS customer_id, o_orderpriority AS booking_type,
        o_orderdate AS booking_datetime FROM trips tr JOIN orders ON l_orderkey = o_orderkey""",
    "city_trips": """SELECT tr.*, n_name AS pickup_city FROM trips tr JOIN supplier ON driver_id = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
    "routed_trips": """SELECT tr.*, a.n_name AS pickup_city, b.n_name AS dropoff_city FROM booked_trips tr
        JOIN supplier ON driver_id = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey
        JOIN customer ON customer_id = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey""",
    "invoices": """SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS invoice_date,
        CAST(o_orderdate + INTERVAL 7 DAY AS DATE) AS due_date, o_totalprice AS total_amount,
        CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN o_totalprice * 0.5::DOUBLE ELSE 0.0::DOUBLE END AS paid_amount,
        CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'P' THEN o_totalprice * 0.5::DOUBLE ELSE o_totalprice END AS outstanding,
        o_orderpriority AS payment_method,
        CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'P' THEN 'Partial' ELSE 'Unpaid' END AS payment_status FROM orders""",
    "customer_fleet": "SELECT c_custkey AS customer_id, n_regionkey AS fleet_id FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "driver_fleet": "SELECT s_suppkey AS driver_id, n_regionkey AS fleet_id FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "fleet_invoices": "SELECT i.*, fleet_id FROM invoices i JOIN customer_fleet USING (customer_id)",
    "fleets": "SELECT r_regionkey AS fleet_id, r_name AS fleet_name FROM region",
    "customers": """SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS customer_type, n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "vehicles": """SELECT p_partkey AS vehicle_id, p_brand AS make, p_type AS category, p_name AS model,
        2001 - p_size % 15 AS year, p_size * 1000 AS odometer_km, p_retailprice AS daily_rate,
        DATE '2001-01-01' + p_size * 10 AS insurance_expiry, DATE '2001-03-01' + p_size * 7 AS fitness_expiry,
        CASE WHEN p_partkey % 10 < 6 THEN 'Available' WHEN p_partkey % 10 < 8 THEN 'On Trip'
             WHEN p_partkey % 10 < 9 THEN 'Maintenance' ELSE 'Retired' END AS status FROM part""",
    "drivers": f"""SELECT s_suppkey AS driver_id, s_name AS full_name, s_nationkey AS nation_id,
        {_profile_sql('s_suppkey')} AS profile, 30000 + 10 * (s_suppkey % 50) AS salary,
        CAST(s_suppkey % 10 AS DOUBLE) / 100 AS brake_rate, CAST(s_suppkey % 7 AS DOUBLE) / 100 AS accel_rate,
        CAST(s_suppkey % 5 AS DOUBLE) / 10 AS idle_rate, CAST(s_suppkey % 4 AS DOUBLE) / 10 AS speeding_rate,
        DATE '2001-03-01' + CAST(s_suppkey % 300 AS INTEGER) AS license_expiry FROM supplier""",
    "telematics": """SELECT event_id AS telem_id, user_id AS driver_id, ts AS trip_date, event_id % 3 AS harsh_brakes,
        event_id % 2 AS harsh_accels, event_id % 60 AS idle_minutes, value / 2 AS speeding_km,
        CAST(GREATEST(0, LEAST(100, CAST(100 - ((event_id % 3) * 1.5 + event_id % 2 + (event_id % 60) * 0.05
            + CAST(value AS DECIMAL(12,2)) * 0.15) AS DECIMAL(18,4)))) AS DOUBLE) AS safety_score,
        event_type = 'error' AS accident, event_type = 'signup' AS complaint, event_id % 5 + 1 AS rating, event_type FROM events""",
    "telem_drivers": f"SELECT DISTINCT user_id AS driver_id, {_profile_sql('user_id')} AS profile FROM events",
    "maintenance": _MAINT_SQL + "lineitem",
    "staged_maintenance": _MAINT_SQL + "staged_lineitem",
    "fuel_logs": """SELECT l_orderkey * 10 + l_linenumber AS fuel_id, l_partkey AS vehicle_id, l_suppkey AS driver_id,
        CAST(l_shipdate AS DATE) AS fill_date,
        CASE l_returnflag WHEN 'A' THEN 'Petrol' WHEN 'N' THEN 'Diesel' ELSE 'CNG' END AS fuel_type, l_quantity AS litres,
        l_quantity * 10 AS km_driven, FLOOR(l_extendedprice / l_quantity) / 100 AS efficiency,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.1 AS DOUBLE) AS fuel_cost FROM lineitem""",
    "opex": """SELECT o_orderkey AS expense_id, o_custkey AS customer_id, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS expense_month,
        o_orderpriority AS category, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.05 AS DOUBLE) AS amount FROM orders""",
}
