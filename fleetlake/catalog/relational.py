"""Filters, joins, aggregates, set operations and top-k on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF
from fleetlake.catalog.registry import A, CI, D, M, P, R, S, SI, TS, query
from fleetlake.constants import BOOKING_MULTIPLIERS
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import count_if, davg, dsum, pct, ratio, rows, sum_if, zero, zero_int
from fleetlake.operators import aggregates as agg
from fleetlake.operators import filters, joins, scale, sets


CUTOFF = "2001-01-01"

# --- filters ---


@query(
    "dim_filter",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
        AND o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31 23:59:59.999999'""",
)
def _(t):
    chosen = {"year": 1998, "o_orderpriority": "5-LOW", "o_orderstatus": "F", "o_custkey": "All"}
    return filters.dim_filter(t["orders"], chosen, "o_orderdate").select("o_orderkey", "o_custkey")


@query("period_slice", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-03-01' AND TIMESTAMP '1999-05-31'")
def _(t):
    return filters.period_slice(t["orders"], "o_orderdate", "1999-03-01", "1999-05-31").select("o_orderkey", "o_totalprice")


def _bounds_sql():
    starts = {
        "hourly": ("DATE_TRUNC('hour', ts)", "INTERVAL 1 HOUR"),
        "daily": ("DATE_TRUNC('day', ts)", "INTERVAL 1 DAY"),
        "weekly": ("DATE_TRUNC('week', ts)", "INTERVAL 7 DAY"),
        "monthly": ("DATE_TRUNC('month', ts)", "INTERVAL 1 MONTH"),
        "quarterly": ("DATE_TRUNC('quarter', ts)", "INTERVAL 3 MONTH"),
        "bi-annual": ("DATE_TRUNC('year', ts) + CASE WHEN EXTRACT(month FROM ts) <= 6 THEN INTERVAL 0 MONTH ELSE INTERVAL 6 MONTH END", "INTERVAL 6 MONTH"),
        "annual": ("DATE_TRUNC('year', ts)", "INTERVAL 12 MONTH"),
    }
    return " UNION ALL ".join(
        f"SELECT '{p}' AS period, {TS(s)} AS period_start, {TS(f'{s} + {step} - INTERVAL 1 SECOND')} AS period_end, COUNT(*) AS n FROM events GROUP BY ALL"
        for p, (s, step) in starts.items()
    )


@query("period_bounds", _bounds_sql())
def _(t):
    parts = []
    for p in filters.PERIODS:
        start, end = filters.period_bounds("ts", p)
        df = t["events"].groupBy(F.lit(p).alias("period"), start.alias("period_start"), end.alias("period_end"))
        parts.append(df.agg(rows().alias("n")))
    return sets.union_all(*parts)


@query("semi_filter", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2')")
def _(t):
    chosen = t["part"].where(F.col("p_brand") == "Brand#2").select(F.col("p_partkey").alias("l_partkey"))
    return filters.semi_filter(t["lineitem"], chosen, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("in_list", "SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def _(t):
    return t["orders"].where(filters.any_of("o_orderpriority", ["1-URGENT", "2-HIGH"])).groupBy("o_orderpriority").agg(rows().alias("n"))


@query("not_in_list", "SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def _(t):
    return t["orders"].where(~filters.any_of("o_orderpriority", ["1-URGENT", "2-HIGH"])).groupBy("o_orderpriority").agg(rows().alias("n"))


@query(
    "like_validate",
    """SELECT lang, COUNT(*) AS n, COUNT(CASE WHEN text LIKE '%@%' THEN 1 END) AS with_at,
        COUNT(CASE WHEN text LIKE '%@%.%' THEN 1 END) AS mail_like FROM documents GROUP BY 1""",
)
def _(t):
    text = F.col("text")
    return t["documents"].groupBy("lang").agg(
        rows().alias("n"), count_if(text.like("%@%")).alias("with_at"), count_if(text.like("%@%.%")).alias("mail_like")
    )


@query(
    "is_null_filter",
    f"""SELECT customer_type, COUNT(*) AS customers, {CI("last_order IS NULL")} AS never, {CI("TRIM(note) = ''")} AS blank_note FROM (
        SELECT c_mktsegment AS customer_type, last_order, CASE WHEN c_acctbal < 0 THEN '  ' ELSE 'ok' END AS note
        FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders
            WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey) GROUP BY 1""",
)
def _(t):
    last = t["orders"].where(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    df = t["customer"].join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    df = df.withColumn("note", F.when(F.col("c_acctbal") < 0, "  ").otherwise("ok"))
    return df.groupBy(F.col("c_mktsegment").alias("customer_type")).agg(
        rows().alias("customers"), count_if(F.col("last_order").isNull()).alias("never"), count_if(filters.blank("note")).alias("blank_note")
    )


@query("between_filter", f"SELECT l_returnflag, COUNT(*) AS n, {S('l_extendedprice')} AS total FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 GROUP BY 1")
def _(t):
    df = t["lineitem"].where(F.col("l_quantity").between(10, 20))
    return df.groupBy("l_returnflag").agg(rows().alias("n"), dsum("l_extendedprice").alias("total"))


@query("sheet_action_filter", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    return filters.sheet_filter(t["customer"], "C_MktSegment", "BUILDING").select("c_custkey", "c_name")


# --- joins ---


@query(
    "join_inner",
    f"""SELECT c_mktsegment, p_type, COUNT(*) AS n, {S('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def _(t):
    df = (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    )
    return df.groupBy("c_mktsegment", "p_type").agg(rows().alias("n"), dsum("l_extendedprice").alias("revenue"))


@query(
    "join_left_agg",
    f"""SELECT v.vehicle_id, v.make, COUNT(tr.trip_id) AS trips, COALESCE({S('tr.trip_fare')}, 0) AS revenue
        FROM vehicles v LEFT JOIN trips tr ON v.vehicle_id = tr.vehicle_id GROUP BY 1, 2""",
)
def _(t):
    return joins.left_with_zero(
        t["vehicles"].select("vehicle_id", "make"), t["trips"], "vehicle_id",
        {"trips": rows(), "revenue": dsum("trip_fare")}, {"trips": 0, "revenue": 0.0},
    )


@query("join_anti", "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(t):
    return t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query(
    "join_not_exists",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
        AND CAST(o_orderdate AS DATE) > DATE '2001-09-01' - 180)""",
)
def _(t):
    recent = t["orders"].where(F.col("o_orderdate") >= F.date_add(F.lit("2001-09-01").cast("date"), -179).cast("timestamp"))
    return t["customer"].join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("join_exists", "SELECT p_partkey, p_brand FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')")
def _(t):
    returned = t["lineitem"].where(F.col("l_returnflag") == "R")
    return t["part"].join(returned, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query(
    "join_self_overlap",
    f"""SELECT customer_id, {D('shared_date')} AS shared_date, invoice_id, next_id, conflicts FROM (
        SELECT customer_id, invoice_date AS shared_date, invoice_id,
            LEAD(invoice_id) OVER (PARTITION BY customer_id, invoice_date ORDER BY invoice_id) AS next_id,
            COUNT(*) OVER (PARTITION BY customer_id, invoice_date) - 1 AS conflicts FROM invoices) WHERE conflicts > 0""",
)
def _(t):
    inv = t["invoices"].select("customer_id", F.col("invoice_date").alias("shared_date"), "invoice_id")
    return joins.same_group_conflicts(inv, ["customer_id", "shared_date"], "invoice_id")


@query(
    "join_cross_matrix",
    """SELECT r.r_name, p.o_orderpriority, COALESCE(n, 0) AS cells FROM region r CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
        LEFT JOIN (SELECT n_regionkey, o_orderpriority, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) x ON x.n_regionkey = r.r_regionkey AND x.o_orderpriority = p.o_orderpriority""",
)
def _(t):
    cells = t["fleet_invoices"].select(F.col("fleet_id"), F.col("payment_method").alias("o_orderpriority"))
    rows = t["region"].select(F.col("r_regionkey").alias("fleet_id"), "r_name")
    return joins.matrix(rows, cells, "fleet_id", "o_orderpriority", t["orders"]).drop("fleet_id")


@query(
    "join_full_reconcile",
    f"""SELECT a.vehicle_id AS left_key, b.vehicle_id AS right_key, CASE WHEN a.vehicle_id IS NULL THEN 'Orphan'
        WHEN b.vehicle_id IS NULL THEN 'Never used' ELSE 'Matched' END AS status FROM (SELECT vehicle_id FROM vehicles WHERE status <> 'Retired') a
        FULL JOIN (SELECT DISTINCT vehicle_id FROM trips) b ON a.vehicle_id = b.vehicle_id""",
)
def _(t):
    active = t["vehicles"].where(F.col("status") != "Retired")
    return joins.reconcile(active, t["trips"], "vehicle_id")


@query(
    "join_outer_balance",
    """SELECT COALESCE(a.city, b.city) AS city, COALESCE(pickups, 0) AS pickups, COALESCE(dropoffs, 0) AS dropoffs,
        COALESCE(pickups, 0) - COALESCE(dropoffs, 0) AS net FROM
        (SELECT pickup_city AS city, COUNT(*) AS pickups FROM routed_trips GROUP BY 1) a FULL JOIN
        (SELECT dropoff_city AS city, COUNT(*) AS dropoffs FROM routed_trips GROUP BY 1) b ON a.city = b.city""",
)
def _(t):
    # both counts from one pass over the joined trips
    r = t["routed_trips"].groupBy("pickup_city", "dropoff_city").agg(rows().alias("n"))
    ends = r.select(
        F.explode(
            F.array(
                F.struct(F.col("pickup_city").alias("city"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("d")),
                F.struct(F.col("dropoff_city").alias("city"), F.lit(0).cast("bigint").alias("p"), F.col("n").alias("d")),
            )
        ).alias("e")
    )
    out = ends.groupBy("e.city").agg(F.sum("e.p").alias("pickups"), F.sum("e.d").alias("dropoffs"))
    return out.withColumn("net", F.col("pickups") - F.col("dropoffs"))


@query(
    "join_cross_scalar",
    f"""WITH m AS (SELECT o_orderpriority, COUNT(*) AS n, {S('o_totalprice')} AS total FROM orders GROUP BY 1)
        SELECT o_orderpriority, n, total, total * 100.0::DOUBLE / (SELECT {S('total')} FROM m) AS share_pct FROM m""",
)
def _(t):
    m = t["orders"].groupBy("o_orderpriority").agg(rows().alias("n"), dsum("o_totalprice").alias("total"))
    return agg.share_of_total(m, "total", "share_pct")


@query(
    "join_spine",
    f"""WITH RECURSIVE b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
        s AS (SELECT lo AS day FROM b UNION ALL SELECT day + 1 FROM s WHERE day < (SELECT hi FROM b))
        SELECT {D('s.day')} AS day, COALESCE(o.n, 0) AS orders, o.n IS NULL AS gap FROM s LEFT JOIN
        (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1) o ON s.day = o.day""",
)
def _(t):
    counts = t["orders"].groupBy(F.to_date("o_orderdate").alias("day")).agg(rows().alias("n"))
    return joins.day_spine(t["orders"], "o_orderdate").join(counts, "day", "left").select(
        "day", zero_int("n").alias("orders"), F.col("n").isNull().alias("gap")
    )


# A short price timeline in the span of the sample orders.
ORDER_PRICE_STEPS = [
    ("1995-06-01", 144.82), ("1996-01-01", 179.86), ("1996-09-01", 224.80), ("1997-05-01", 249.80), ("1998-02-01", 290.45),
    ("1998-11-01", 279.75), ("1999-07-01", 268.42), ("2000-03-01", 255.63), ("2000-12-01", 249.50), ("2001-05-01", 243.80),
]


def _steps_sql(steps, col, default):
    whens = " ".join(f"WHEN {col} >= DATE '{d}' THEN {v}::DOUBLE" for d, v in sorted(steps, reverse=True))
    return f"CASE {whens} ELSE {default}::DOUBLE END"


@query("join_asof", f"SELECT invoice_id, {_steps_sql(ORDER_PRICE_STEPS, 'invoice_date', 220.0)} AS price FROM invoices")
def _(t):
    return t["invoices"].select(
        "invoice_id", joins.price_steps(ORDER_PRICE_STEPS, F.col("invoice_date"), 220.0).alias("price")
    )


@query(
    "join_asof_table",
    """WITH daily AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS since, MAX(o_totalprice) AS price FROM orders GROUP BY 1, 2)
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::DATE::VARCHAR AS ship_day, d.price FROM
        (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey) f
        ASOF LEFT JOIN daily d ON f.o_orderpriority = d.o_orderpriority AND f.l_shipdate::DATE >= d.since""",
)
def _(t):
    daily = t["orders"].groupBy("o_orderpriority", F.to_date("o_orderdate").alias("since")).agg(F.max("o_totalprice").alias("price"))
    facts = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_day"), "o_orderpriority"
    )
    out = joins.asof_join(facts, daily, ["o_orderpriority"], "ship_day", "since", "price")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ship_day", "price")


_VERSIONS = """(SELECT c_custkey, c_mktsegment || v.tag AS segment, v.valid_from, v.valid_to FROM customer, (VALUES
    ('', DATE '1900-01-01', DATE '1998-06-30'), ('/new', DATE '1998-07-01', DATE '9999-12-31')) v(tag, valid_from, valid_to))"""


def customer_versions(t):
    """Two versions per customer: before and from 1998-07-01."""
    versions = F.array(
        F.struct(F.lit("").alias("tag"), F.lit("1900-01-01").cast("date").alias("f"), F.lit("1998-06-30").cast("date").alias("u")),
        F.struct(F.lit("/new").alias("tag"), F.lit("1998-07-01").cast("date").alias("f"), F.lit("9999-12-31").cast("date").alias("u")),
    )
    df = t["customer"].withColumn("v", F.explode(versions))
    return df.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat("c_mktsegment", "v.tag").alias("segment"),
        F.col("v.f").alias("valid_from"),
        F.col("v.u").alias("valid_to"),
    )


@query(
    "join_point_in_time",
    f"""SELECT segment, COUNT(*) AS n, {S('total_amount')} AS billed FROM invoices i JOIN {_VERSIONS} v
        ON i.customer_id = v.c_custkey AND i.invoice_date BETWEEN v.valid_from AND v.valid_to GROUP BY 1""",
)
def _(t):
    df = joins.point_in_time(t["invoices"], customer_versions(t), "customer_id", "invoice_date")
    return df.groupBy("segment").agg(rows().alias("n"), dsum("total_amount").alias("billed"))


@query(
    "join_route_lookup",
    """WITH pairs AS (SELECT pickup_city, dropoff_city, COUNT(*) AS trips FROM routed_trips WHERE pickup_city <> dropoff_city GROUP BY 1, 2),
        places AS (SELECT n_name, 24.0::DOUBLE + n_nationkey * 0.4::DOUBLE AS lat, 66.0::DOUBLE + n_nationkey * 0.3::DOUBLE AS lon FROM nation),
        x AS (SELECT p.*, POW(SIN(RADIANS(b.lat - a.lat) / 2), 2) + COS(RADIANS(a.lat)) * COS(RADIANS(b.lat)) * POW(SIN(RADIANS(b.lon - a.lon) / 2), 2) AS h
            FROM pairs p JOIN places a ON pickup_city = a.n_name JOIN places b ON dropoff_city = b.n_name)
        SELECT pickup_city, dropoff_city, trips, CASE WHEN LEAST(pickup_city, dropoff_city) = 'NATION_0' AND GREATEST(pickup_city, dropoff_city) = 'NATION_1'
            THEN 380.0::DOUBLE ELSE ROUND(6371.0 * 2 * ATAN2(SQRT(h), SQRT(1 - h)) * 1.3, 1) END AS distance_km FROM x""",
)
def _(t):
    places = t["nation"].select(
        "n_name", (24.0 + F.col("n_nationkey") * 0.4).alias("lat"), (66.0 + F.col("n_nationkey") * 0.3).alias("lon")
    )
    pairs = t["routed_trips"].where(F.col("pickup_city") != F.col("dropoff_city")).groupBy("pickup_city", "dropoff_city").agg(rows().alias("trips"))
    a = places.select(F.col("n_name").alias("pickup_city"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = places.select(F.col("n_name").alias("dropoff_city"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    known = t.spark.createDataFrame([("NATION_1", "NATION_0", 380.0)], "place_a string, place_b string, km double")
    df = pairs.join(a, "pickup_city").join(b, "dropoff_city")
    out = joins.route_distance(df, known, "pickup_city", "dropoff_city", "lat1", "lon1", "lat2", "lon2")
    return out.select("pickup_city", "dropoff_city", "trips", "distance_km")


@query(
    "join_preagg",
    f"""SELECT v.vehicle_id, COALESCE(trips, 0) AS trips, COALESCE(revenue, 0) AS revenue, COALESCE(fuel, 0) AS fuel, COALESCE(maint, 0) AS maint
        FROM vehicles v LEFT JOIN (SELECT vehicle_id, COUNT(*) AS trips, {S('trip_fare')} AS revenue FROM trips GROUP BY 1) a USING (vehicle_id)
        LEFT JOIN (SELECT vehicle_id, {S('fuel_cost')} AS fuel FROM fuel_logs GROUP BY 1) b USING (vehicle_id)
        LEFT JOIN (SELECT vehicle_id, {S('total_cost')} AS maint FROM maintenance GROUP BY 1) c USING (vehicle_id)""",
)
def _(t):
    parts = [
        t["trips"].groupBy("vehicle_id").agg(rows().alias("trips"), dsum("trip_fare").alias("revenue")),
        t["fuel_logs"].groupBy("vehicle_id").agg(dsum("fuel_cost").alias("fuel")),
        t["maintenance"].groupBy("vehicle_id").agg(dsum("total_cost").alias("maint")),
    ]
    out = joins.preaggregated(t["vehicles"].select("vehicle_id"), "vehicle_id", parts)
    return out.select("vehicle_id", zero_int("trips").alias("trips"), *[zero(c).alias(c) for c in ("revenue", "fuel", "maint")])


@query(
    "join_rate_compare",
    f"""WITH a AS (SELECT category, COUNT(*) AS trips, {S('trip_fare')} / {S('duration_days')} AS actual FROM trips JOIN vehicles USING (vehicle_id) GROUP BY 1),
        l AS (SELECT category, {A('daily_rate')} AS listed FROM vehicles GROUP BY 1)
        SELECT category, trips, actual, listed, actual - listed AS gap, (actual - listed) * 100.0::DOUBLE / listed AS gap_pct FROM a JOIN l USING (category)""",
)
def _(t):
    v = t["vehicles"].select("vehicle_id", "category")
    per_vehicle = t["trips"].groupBy("vehicle_id").agg(
        rows().alias("trips"), fn.msum("trip_fare").alias("fare"), fn.msum("duration_days").alias("days")
    )
    a = per_vehicle.join(v, "vehicle_id").groupBy("category").agg(
        F.sum("trips").alias("trips"), ratio(F.sum("fare"), F.sum("days")).alias("actual")
    )
    listed = t["vehicles"].groupBy("category").agg(davg("daily_rate").alias("listed"))
    gap = F.col("actual") - F.col("listed")
    return a.join(listed, "category").withColumns({"gap": gap, "gap_pct": pct(gap, "listed")})


@query("join_scalar_subquery", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT {A('o_totalprice')} FROM orders)")
def _(t):
    mean = t["orders"].agg(davg("o_totalprice")).scalar()
    return t["orders"].where(F.col("o_totalprice") > mean).select("o_orderkey", "o_totalprice")


@query(
    "join_correlated_max",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders o WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)",
)
def _(t):
    top = t["orders"].groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    return t["orders"].select("o_custkey", "o_orderkey", "o_totalprice").join(top, ["o_custkey", "o_totalprice"], "left_semi")


# --- aggregates ---


@query(
    "agg_basic",
    f"""SELECT l_returnflag, COUNT(*) AS row_count, {S('l_extendedprice')} AS total, {A('l_extendedprice')} AS mean, MIN(l_extendedprice) AS lowest,
        MAX(l_extendedprice) AS highest, ROUND(STDDEV_SAMP(l_extendedprice), 4) AS std_dev, ROUND(VAR_SAMP(l_extendedprice), 2) AS variance FROM lineitem GROUP BY 1""",
)
def _(t):
    return agg.basic_stats(t["lineitem"], ["l_returnflag"], "l_extendedprice")


@query("agg_having", f"SELECT o_custkey, COUNT(*) AS n, {S('o_totalprice')} AS spend FROM orders GROUP BY 1 HAVING COUNT(*) >= 12 AND {S('o_totalprice')} > 1000000")
def _(t):
    g = t["orders"].groupBy("o_custkey").agg(rows().alias("n"), dsum("o_totalprice").alias("spend"))
    return g.where((F.col("n") >= 12) & (F.col("spend") > 1_000_000))


@query(
    "agg_filter",
    f"""SELECT l_linestatus, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned, {SI("l_returnflag <> 'R'", 'l_extendedprice')} AS kept_value,
        {SI("l_discount > 0.05", 'l_extendedprice')} AS discounted FROM lineitem GROUP BY 1""",
)
def _(t):
    flag = F.col("l_returnflag")
    return t["lineitem"].groupBy("l_linestatus").agg(
        count_if(flag == "R").alias("returned"),
        sum_if(flag != "R", "l_extendedprice").alias("kept_value"),
        sum_if(F.col("l_discount") > 0.05, "l_extendedprice").alias("discounted"),
    )


@query(
    "agg_rollup",
    f"""SELECT CASE WHEN GROUPING(y) = 1 THEN 'All years' ELSE CAST(y AS VARCHAR) END AS year_label,
        CASE WHEN GROUPING(m) = 1 THEN 'All months' ELSE CAST(m AS VARCHAR) END AS month_label, COUNT(*) AS n, {S('o_totalprice')} AS total
        FROM (SELECT EXTRACT(year FROM o_orderdate) AS y, EXTRACT(month FROM o_orderdate) AS m, o_totalprice FROM orders) GROUP BY ROLLUP (y, m)""",
)
def _(t):
    base = t["orders"].groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        rows().alias("n"), fn.msum("o_totalprice").alias("s")
    )
    out = base.rollup("y", "m").agg(
        F.sum("n").alias("n"), F.sum("s").cast("double").alias("total"), F.grouping("y").alias("gy"), F.grouping("m").alias("gm")
    )
    return out.select(
        F.when(F.col("gy") == 1, "All years").otherwise(F.col("y").cast("string")).alias("year_label"),
        F.when(F.col("gm") == 1, "All months").otherwise(F.col("m").cast("string")).alias("month_label"),
        "n",
        "total",
    )


@query(
    "agg_cube",
    f"""SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus) AS INTEGER) AS all_status, CAST(GROUPING(o_orderpriority) AS INTEGER) AS all_priority,
        COUNT(*) AS n, {S('o_totalprice')} AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def _(t):
    # finest level first, so the cube multiplies a handful of rows and not the table
    base = t["orders"].groupBy("o_orderstatus", "o_orderpriority").agg(rows().alias("n"), fn.msum("o_totalprice").alias("s"))
    return base.cube("o_orderstatus", "o_orderpriority").agg(
        F.grouping("o_orderstatus").cast("int").alias("all_status"),
        F.grouping("o_orderpriority").cast("int").alias("all_priority"),
        F.sum("n").alias("n"),
        F.sum("s").cast("double").alias("total"),
    )


@query(
    "agg_grouping_sets",
    f"""SELECT customer_type, city, COUNT(*) AS n, {S('total_amount')} AS total FROM invoices JOIN customers USING (customer_id)
        GROUP BY GROUPING SETS ((customer_type, city), (customer_type), (city), ())""",
)
def _(t):
    per_customer = t["invoices"].groupBy("customer_id").agg(rows().alias("n"), fn.msum("total_amount").alias("s"))
    base = per_customer.join(t["customers"], "customer_id").groupBy("customer_type", "city").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    levels = [["customer_type", "city"], ["customer_type"], ["city"], []]
    return base.groupingSets([[F.col(c) for c in level] for level in levels], "customer_type", "city").agg(
        F.sum("n").alias("n"), F.sum("s").cast("double").alias("total")
    )


@query(
    "agg_distinct",
    "SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1",
)
def _(t):
    return t["orders"].groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct(F.to_date("o_orderdate")).alias("days")
    )


_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@query(
    "agg_percentiles",
    "SELECT l_returnflag, " + ", ".join(f"ROUND(QUANTILE_CONT(l_extendedprice, {p}), 4) AS {n}" for n, p in _PROBS.items())
    + ", ROUND(QUANTILE_CONT(l_extendedprice, 0.75) - QUANTILE_CONT(l_extendedprice, 0.25), 4) AS iqr FROM lineitem GROUP BY 1",
)
def _(t):
    q = scale.percentiles(t["lineitem"], ["l_returnflag"], "l_extendedprice", _PROBS)
    return q.select(
        "l_returnflag", *[F.round(n, 4).alias(n) for n in _PROBS], F.round(F.col("p75") - F.col("p25"), 4).alias("iqr")
    )


@query(
    "agg_cv",
    f"""SELECT l_suppkey, COUNT(*) AS row_count, {A('l_extendedprice')} AS mean, ROUND(STDDEV_SAMP(l_extendedprice) * 100.0 / {A('l_extendedprice')}, 4) AS cv_pct
        FROM lineitem GROUP BY 1 HAVING COUNT(*) >= 5""",
)
def _(t):
    return agg.coefficient_of_variation(t["lineitem"], ["l_suppkey"], "l_extendedprice", 5)


YEARS = list(range(1995, 2002))
_YEAR_LIST = ", ".join(map(str, YEARS))


@query(
    "agg_pivot_case",
    "SELECT EXTRACT(month FROM o_orderdate) AS month_num, "
    + ", ".join(f"{SI(f'EXTRACT(year FROM o_orderdate) = {y}', 'o_totalprice')} AS rev_{y}" for y in YEARS)
    + f", {SI(f'EXTRACT(year FROM o_orderdate) NOT IN ({_YEAR_LIST})', 'o_totalprice')} AS rev_other FROM orders GROUP BY 1",
)
def _(t):
    df = t["orders"].withColumn("month_num", F.month("o_orderdate").cast("bigint"))
    return agg.pivot_sum(df, ["month_num"], F.year("o_orderdate"), YEARS, F.col("o_totalprice"), "rev_", other="rev_other")


@query(
    "agg_pivot_table",
    "SELECT event_type, " + ", ".join(f"{CI(f'EXTRACT(hour FROM ts) = {h}')} AS h{h}" for h in range(24)) + " FROM events GROUP BY 1",
)
def _(t):
    return agg.pivot_count(t["events"], ["event_type"], F.hour("ts"), list(range(24)), "h")


@query("agg_string_list", "SELECT p_brand, STRING_AGG(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def _(t):
    return agg.distinct_list(t["part"], ["p_brand"], "p_type", "types")


@query("agg_value_counts", f"SELECT o_orderpriority, COUNT(*) AS row_count, {P('COUNT(*)', '(SELECT COUNT(*) FROM orders)')} AS share_pct FROM orders GROUP BY 1")
def _(t):
    return agg.value_counts(t["orders"], "o_orderpriority")


@query("agg_argmax", f"SELECT event_type, {S('value')} AS measure FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def _(t):
    return agg.argmax(t["events"], "event_type", dsum("value"))


@query("agg_boolean", f"SELECT l_linestatus, {P(CI('l_returnflag = ' + chr(39) + 'R' + chr(39)), 'COUNT(*)')} AS return_pct, {CI('l_discount = 0')} AS undiscounted FROM lineitem GROUP BY 1")
def _(t):
    return t["lineitem"].groupBy("l_linestatus").agg(
        pct(count_if(F.col("l_returnflag") == "R"), rows()).alias("return_pct"), count_if(F.col("l_discount") == 0).alias("undiscounted")
    )


@query(
    "agg_of_agg",
    "SELECT o_orderpriority, AVG(n) AS avg_per_month, MAX(n) AS best_month FROM (SELECT o_orderpriority, DATE_TRUNC('month', o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1",
)
def _(t):
    m = t["orders"].groupBy("o_orderpriority", fn.month_start("o_orderdate").alias("m")).agg(rows().alias("n"))
    return m.groupBy("o_orderpriority").agg(F.avg("n").alias("avg_per_month"), F.max("n").alias("best_month"))


@query(
    "agg_histogram",
    """WITH b AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events)
        SELECT LEAST(CAST(FLOOR((value - lo) * 20.0::DOUBLE / (hi - lo)) AS BIGINT), 19) AS bin, COUNT(*) AS row_count FROM events, b GROUP BY 1""",
)
def _(t):
    return agg.histogram(t["events"], "value", 20)


@query(
    "agg_boxplot",
    """WITH q AS (SELECT event_type, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3 FROM events GROUP BY 1),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
        SELECT event_type, ROUND(q1, 4) AS q1, ROUND(median, 4) AS median, ROUND(q3, 4) AS q3, ROUND(lo, 4) AS lower_fence, ROUND(hi, 4) AS upper_fence,
            COUNT(CASE WHEN value < lo OR value > hi THEN 1 END) AS outliers FROM events JOIN f USING (event_type) GROUP BY ALL""",
)
def _(t):
    box = agg.boxplot(t["events"], ["event_type"], "value")
    return box.select("event_type", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")], "outliers")


@query(
    "agg_grid",
    f"SELECT ROUND(l_quantity / 10, 0) AS x_cell, ROUND(l_discount * 100, 0) AS y_cell, COUNT(*) AS n, {S('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return agg.grid(
        t["lineitem"], F.round(F.col("l_quantity") / 10, 0), F.round(F.col("l_discount") * 100, 0),
        {"n": rows(), "revenue": dsum("l_extendedprice")},
    )


@query("agg_sheet", f"SELECT c_mktsegment, {A('c_acctbal')} AS result FROM customer GROUP BY 1 ORDER BY 2 DESC LIMIT 100")
def _(t):
    return agg.sheet_aggregate(t["customer"], "c_mktsegment", "avg", "c_acctbal")


@query(
    "agg_sheet_pivot",
    "SELECT o_orderpriority, " + ", ".join(f"COUNT(CASE WHEN o_orderstatus = '{s}' THEN 1 END) AS {s}" for s in "FOP") + " FROM orders GROUP BY 1",
)
def _(t):
    values = joins.first_values(t["orders"], "o_orderstatus", 12)  # a sheet shows the first twelve
    return agg.pivot_count(t["orders"], ["o_orderpriority"], F.col("o_orderstatus"), values)


@query(
    "agg_back_propagate",
    f"SELECT c_custkey, COALESCE(n, 0) AS bookings, COALESCE(spend, 0) AS spend FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, {S('o_totalprice')} AS spend FROM orders GROUP BY 1) ON c_custkey = o_custkey",
)
def _(t):
    facts = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    return agg.back_propagate(t["customer"].select("c_custkey"), facts, "c_custkey", {"bookings": rows(), "spend": dsum("o_totalprice")})


# --- sort, top-k, sample ---


@query("top_n", f"SELECT o_custkey, {S('o_totalprice')} AS revenue FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    g = t["orders"].groupBy("o_custkey").agg(dsum("o_totalprice").alias("revenue"))
    return g.orderBy(F.desc("revenue"), "o_custkey").limit(10)


@query(
    "top_n_per_group",
    """SELECT * FROM (SELECT n_name, o_orderkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) WHERE rn <= 3""",
)
def _(t):
    df = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return sets.top_n_per_group(df.select("n_name", "o_orderkey", "o_totalprice"), ["n_name"], ["-o_totalprice", "o_orderkey"], 3)


@query(
    "sort_custom",
    "SELECT DAYNAME(o_orderdate) AS dow, EXTRACT(isodow FROM o_orderdate) AS sort_rank, COUNT(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 2",
)
def _(t):
    rank = (F.weekday("o_orderdate") + 1).cast("bigint")
    return t["orders"].groupBy(F.date_format("o_orderdate", "EEEE").alias("dow"), rank.alias("sort_rank")).agg(rows().alias("n")).orderBy("sort_rank")


@query(
    "sort_nulls",
    f"""SELECT vehicle_id, {D('last_trip')} AS last_trip FROM vehicles LEFT JOIN (SELECT vehicle_id, MAX(pickup_datetime) AS last_trip FROM trips WHERE status = 'Cancelled' GROUP BY 1)
        USING (vehicle_id) ORDER BY last_trip DESC NULLS FIRST, vehicle_id LIMIT 100""",
)
def _(t):
    last = t["trips"].where(F.col("status") == "Cancelled").groupBy("vehicle_id").agg(F.to_date(F.max("pickup_datetime")).alias("last_trip"))
    df = t["vehicles"].select("vehicle_id").join(last, "vehicle_id", "left")
    return df.orderBy(F.col("last_trip").desc_nulls_first(), "vehicle_id").limit(100)


@query("sample_fixed", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY MD5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 500")
def _(t):
    return sets.sample_rows(t["orders"].select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500, 42)


@query(
    "sort_by_expr",
    f"""WITH s AS (SELECT AVG(o_totalprice) AS m, STDDEV_SAMP(o_totalprice) AS sd FROM orders)
        SELECT o_orderkey, ROUND((o_totalprice - m) / sd, 6) AS z FROM orders, s ORDER BY ABS((o_totalprice - m) / sd) DESC, o_orderkey LIMIT 50""",
)
def _(t):
    o = t["orders"]
    mean, sd = o.agg(F.avg("o_totalprice")).scalar(), o.agg(F.stddev_samp("o_totalprice")).scalar()
    z = (F.col("o_totalprice") - mean) / sd
    return o.select("o_orderkey", z.alias("z")).orderBy(F.abs("z").desc(), "o_orderkey").limit(50).select("o_orderkey", F.round("z", 6).alias("z"))


# --- set operations ---


@query("union_all", "SELECT c_name AS name, 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, 'supplier', s_nationkey FROM supplier")
def _(t):
    c = t["customer"].select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    s = t["supplier"].select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    return sets.union_all(c, s)


@query("distinct", "SELECT DISTINCT n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    shipping = t["supplier"].join(t["lineitem"], F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    return shipping.join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select("n_name").distinct()


@query("dedup_latest", f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, {D('l_shipdate')} AS ship_day FROM staged_lineitem")
def _(t):
    return t["staged_lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.to_date("l_shipdate").alias("ship_day"))


def _order_delta(t):
    """Late orders with a new price, plus keys the target does not hold yet."""
    o = t["orders"]
    changed = o.where(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    fresh = changed.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000_000)
    return sets.union_all(changed, fresh)


_DELTA = f"""(SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'
    UNION ALL SELECT o_orderkey + 1000000000000, o_custkey, o_totalprice + 1 FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}')"""


@query(
    "insert_new",
    f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders UNION ALL SELECT * FROM {_DELTA} d WHERE NOT EXISTS
        (SELECT 1 FROM orders o WHERE o.o_orderkey = d.o_orderkey)""",
)
def _(t):
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    return sets.insert_new(t["orders"].select(*cols), _order_delta(t).select(*cols), ["o_orderkey"])


@query(
    "upsert",
    f"""SELECT COALESCE(d.o_orderkey, o.o_orderkey) AS o_orderkey, COALESCE(d.o_custkey, o.o_custkey) AS o_custkey,
        COALESCE(d.o_totalprice, o.o_totalprice) AS o_totalprice FROM orders o FULL JOIN {_DELTA} d ON o.o_orderkey = d.o_orderkey""",
)
def _(t):
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    return sets.upsert(t["orders"].select(*cols), _order_delta(t).select(*cols), ["o_orderkey"])


@query("duplicate_groups", "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return sets.duplicate_groups(t["lineitem"], ["l_orderkey", "l_linenumber"])
