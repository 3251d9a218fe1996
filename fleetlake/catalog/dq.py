"""Data-quality checks and profiles on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.adapters import BASE_TABLES
from fleetlake.catalog.registry import A, CI, D, P, S, TS, query
from fleetlake.catalog.relational import CUTOFF, customer_versions
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import count_if, rows
from fleetlake.operators import sets
from fleetlake.operators.aggregates import value_counts
from fleetlake.quality import checks, profile
from fleetlake.session import scratch_path
from fleetlake.sources.tables import read_csv


def _holes(t):
    """Customers with a blank name for negative balances and no e-mail sign in some segments."""
    neg = F.col("c_acctbal") < 0
    return t["customer"].select(
        F.when(~neg, F.col("c_custkey")).alias("customer_id"), F.when(F.col("c_acctbal") > 9000, "  ").otherwise(F.col("c_name")).alias("full_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.concat("c_name", F.lit("@mail.example"))).alias("email"),
    )


_HOLES = """(SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS customer_id, CASE WHEN c_acctbal > 9000 THEN '  ' ELSE c_name END AS full_name,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_name || '@mail.example' END AS email FROM customer)"""


@query(
    "dq_null_summary",
    f"""SELECT 'trips' AS table_name, COUNT(*) AS total, {CI('vehicle_id IS NULL')} AS null_key, {CI('trip_fare <= 0')} AS bad_value, {P(CI('trip_fare <= 0'), 'COUNT(*)')} AS issue_pct FROM trips
        UNION ALL SELECT 'customers', COUNT(*), {CI("customer_id IS NULL OR TRIM(full_name) = ''")}, {CI("email NOT LIKE '%@%'")}, {P(CI("email NOT LIKE '%@%'"), 'COUNT(*)')} FROM {_HOLES}
        UNION ALL SELECT 'invoices', COUNT(*), {CI('total_amount IS NULL')}, {CI('total_amount <= 1000')}, {P(CI('total_amount <= 1000'), 'COUNT(*)')} FROM invoices""",
)
def _(t):
    return sets.union_all(
        checks.null_summary(t["trips"], "trips", F.col("vehicle_id").isNull(), F.col("trip_fare") <= 0),
        checks.null_summary(_holes(t), "customers", F.col("customer_id").isNull() | (F.trim("full_name") == ""), ~F.col("email").like("%@%")),
        checks.null_summary(t["invoices"], "invoices", F.col("total_amount").isNull(), F.col("total_amount") <= 1000),
    )


def shipped(t):
    return t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "dq_timeline",
    f"""SELECT l_orderkey, l_linenumber, {D('o_orderdate')} AS booked, {D('l_shipdate')} AS shipped, DATE_DIFF('hour', o_orderdate, l_shipdate) AS dur_hours
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def _(t):
    bad = shipped(t).where(F.col("l_shipdate") < F.col("o_orderdate"))
    return bad.select(
        "l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("booked"), F.to_date("l_shipdate").alias("shipped"), fn.hours_between("o_orderdate", "l_shipdate").alias("dur_hours")
    )


@query("dq_range", "SELECT fuel_id, vehicle_id, km_driven, litres, efficiency FROM fuel_logs WHERE efficiency < 3 OR efficiency > 35")
def _(t):
    return t["fuel_logs"].where(~F.col("efficiency").between(3, 35)).select("fuel_id", "vehicle_id", "km_driven", "litres", "efficiency")


@query("dq_duplicates", "SELECT l_orderkey * 10 + l_linenumber AS trip_id, COUNT(*) AS copies FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def _(t):
    return sets.duplicate_groups(t["trips"], ["trip_id"])


@query(
    "dq_orphans",
    f"""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""",
)
def _(t):
    # orders still partly open do not count as parents, so that there are orphans to find
    parents = t["orders"].where(F.col("o_orderstatus") != "P")
    return t["lineitem"].join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


def _summary_sql(table):
    return f"""SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {table}) AS total, CAST(0 AS BIGINT) AS null_rows,
        (SELECT COUNT(*) FROM {table}) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {table})) AS duplicates, CAST(0 AS DOUBLE) AS issue_pct, 'Good' AS status"""


@query("dq_summary", " UNION ALL ".join(_summary_sql(n) for n in BASE_TABLES))
def _(t):
    return sets.union_all(*[checks.table_summary(t[n], n) for n in BASE_TABLES])


_STATUSES = ["F", "O", "P"]


def _rules(t):
    return [
        checks.Rule("order key set", "not_null", "o_orderkey"),
        checks.Rule("price in range", "range", "o_totalprice", {"low": 1000, "high": 400_000}),
        checks.Rule("known status", "accepted_values", "o_orderstatus", {"values": _STATUSES}),
        checks.Rule("priority format", "format", "o_orderpriority", {"pattern": "^[1-5]-[A-Z ]+$"}),
        checks.Rule("few open orders", "threshold", "o_orderstatus", {"condition": F.col("o_orderstatus") == "O", "limit": 30.0}),
        checks.Rule("order key unique", "unique", "o_orderkey"),
        checks.Rule("customer exists", "referential", "o_custkey", {"parent": t["customer"], "parent_column": "c_custkey"}),
    ]


@query(
    "dq_tests",
    f"""WITH r AS (SELECT * FROM (SELECT 'order key set' AS rule, COUNT(*) AS checked, {CI('o_orderkey IS NULL')} AS failed FROM orders UNION ALL
        SELECT 'price in range', COUNT(*), {CI('o_totalprice NOT BETWEEN 1000 AND 400000')} FROM orders UNION ALL
        SELECT 'known status', COUNT(*), {CI("o_orderstatus NOT IN ('F', 'O', 'P')")} FROM orders UNION ALL
        SELECT 'priority format', COUNT(*), {CI("NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')")} FROM orders UNION ALL
        SELECT 'few open orders', COUNT(*), {CI("o_orderstatus = 'O'")} FROM orders UNION ALL
        SELECT 'order key unique', COUNT(*), COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders UNION ALL
        SELECT 'customer exists', COUNT(*), {CI('c_custkey IS NULL')} FROM orders LEFT JOIN customer ON o_custkey = c_custkey))
        SELECT 'orders' AS table_name, rule, checked, failed, CASE WHEN rule = 'few open orders' THEN failed * 100.0 / checked <= 30 ELSE failed = 0 END AS passed FROM r
        UNION ALL SELECT 'dim_customer', 'scd2 integrity', COUNT(*), 0, TRUE FROM customer""",
)
def _(t):
    dim = customer_versions(t).withColumn("is_current", F.col("valid_to") == F.lit("9999-12-31").cast("date"))
    return sets.union_all(
        checks.run_rules(t["orders"], "orders", _rules(t)),
        checks.run_rules(dim, "dim_customer", [checks.Rule("scd2 integrity", "scd2", "customer_id")]),
    )


def _checks():
    return {
        "timeline_reversed": F.col("l_shipdate") < F.col("o_orderdate"), "deep_discount": F.col("l_discount") >= 0.1, "zero_tax": F.col("l_tax") == 0,
        "large_quantity": F.col("l_quantity") > 45, "low_price": F.col("l_extendedprice") < 1000, "returned_open": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
    }


_CHECK_SQL = {
    "timeline_reversed": "l_shipdate < o_orderdate", "deep_discount": "l_discount >= 0.1::DOUBLE", "zero_tax": "l_tax = 0", "large_quantity": "l_quantity > 45",
    "low_price": "l_extendedprice < 1000", "returned_open": "l_returnflag = 'R' AND l_linestatus = 'O'",
}


@query(
    "dq_flags",
    "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"({c}) AS _dq_{n}" for n, c in _CHECK_SQL.items()) + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def _(t):
    flags = _checks()
    return checks.flag_rows(shipped(t), flags).select("l_orderkey", "l_linenumber", "l_partkey", *[f"_dq_{n}" for n in flags])


@query(
    "dq_issue_log",
    "SELECT table_name, check_name, COUNT(*) AS n, COUNT(DISTINCT row_key) AS keys FROM (" + " UNION ALL ".join(
        f"SELECT 'lineitem' AS table_name, CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber AS row_key, '{n}' AS check_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {c}" for n, c in _CHECK_SQL.items()
    ) + ") GROUP BY 1, 2",
)
def _(t):
    log = checks.issue_log(shipped(t), "lineitem", F.concat_ws("/", "l_orderkey", "l_linenumber"), _checks())
    path = scratch_path(t.spark, "dq_issues")
    # a line has one order, so the log has at most one row per line and check
    checks.dealt_issues(log, t["lineitem"].count(), len(_checks())).write.partitionBy("check_name").parquet(path)
    return checks.issue_counts(t.spark.read.parquet(path))


@query(
    "quarantine",
    f"""SELECT CONCAT_WS('; ', CASE WHEN bad_no THEN 'key not a number' END, CASE WHEN o_totalprice < 10000 THEN 'price below 10000' END) AS reject_reason, COUNT(*) AS n FROM (
        SELECT *, o_orderstatus = 'P' AS bad_no FROM orders) GROUP BY 1""",
)
def _(t):
    # raw text file in which the keys of partly delivered orders are damaged
    folder = scratch_path(t.spark, "inbox")
    key = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    t["orders"].select(key.alias("key"), F.col("o_totalprice").cast("string").alias("price")).write.option("header", True).csv(folder)
    raw = read_csv(t.spark, folder, "key string, price string")
    number, price = F.col("key").try_cast("bigint"), F.col("price").try_cast("double")
    valid, rejected = checks.split_quarantine(raw, {"key not a number": number.isNull(), "price below 10000": price < 10_000})
    good = valid.agg(rows().alias("n")).select(F.lit("").alias("reject_reason"), "n")
    return sets.union_all(good, rejected.groupBy("reject_reason").agg(rows().alias("n")))


def _profile_sql(table, cols):
    out = []
    for c, numeric in cols.items():
        num = f"CAST({c} AS DOUBLE)" if numeric else "NULL::DOUBLE"
        out.append(
            f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, {CI(f'{c} IS NULL')} AS nulls, MIN({num}) AS lowest, MAX({num}) AS highest,
            CAST(SUM(CAST({num} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({c}) AS mean, COUNT(DISTINCT {c}) AS distinct_values, 0.0::DOUBLE AS null_pct, 'Good' AS health,
            (SELECT STRING_AGG(v || ' (' || n || ')', ', ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM {table} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)) AS top_values FROM {table}"""
        )
    return " UNION ALL ".join(out)


@query("profile_columns", _profile_sql("customer", {"c_custkey": 1, "c_name": 0, "c_nationkey": 1, "c_acctbal": 1, "c_mktsegment": 0}))
def _(t):
    return profile.profile_columns(t["customer"])


@query(
    "profile_lineitem",
    _profile_sql("lineitem", {"l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_extendedprice": 1, "l_discount": 1, "l_returnflag": 0, "l_linestatus": 0}),
)
def _(t):
    cols = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
    return profile.profile_columns(t["lineitem"].select(*cols))


@query(
    "profile_outliers",
    """WITH q AS (SELECT QUANTILE_CONT(l_extendedprice, 0.25) AS q1, QUANTILE_CONT(l_extendedprice, 0.5) AS median, QUANTILE_CONT(l_extendedprice, 0.75) AS q3 FROM lineitem),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
        SELECT ROUND(ANY_VALUE(q1), 4) AS q1, ROUND(ANY_VALUE(median), 4) AS median, ROUND(ANY_VALUE(q3), 4) AS q3, ROUND(ANY_VALUE(lo), 4) AS lower_fence, ROUND(ANY_VALUE(hi), 4) AS upper_fence,
        COUNT(*) AS row_count, COUNT(CASE WHEN l_extendedprice < lo OR l_extendedprice > hi THEN 1 END) AS outliers,
        COUNT(CASE WHEN l_extendedprice < lo OR l_extendedprice > hi THEN 1 END) * 100.0::DOUBLE / COUNT(*) AS outlier_pct FROM lineitem, f""",
)
def _(t):
    df = profile.outliers(t["lineitem"], "l_extendedprice")
    rounded = {c: F.round(c, 4) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")}
    return df.withColumns(rounded)


@query("profile_top_values", f"SELECT o_custkey, COUNT(*) AS row_count, {P('COUNT(*)', '(SELECT COUNT(*) FROM orders)')} AS share_pct FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    return value_counts(t["orders"], "o_custkey").orderBy(F.desc("row_count"), "o_custkey").limit(10)


@query(
    "distribution_stats",
    """SELECT COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean, ROUND(STDDEV_SAMP(o_totalprice), 4) AS std, ROUND(QUANTILE_CONT(o_totalprice, 0.25), 4) AS p25, ROUND(QUANTILE_CONT(o_totalprice, 0.5), 4) AS median,
        ROUND(QUANTILE_CONT(o_totalprice, 0.75), 4) AS p75, ROUND(QUANTILE_CONT(o_totalprice, 0.95), 4) AS p95, ROUND(QUANTILE_CONT(o_totalprice, 0.75) - QUANTILE_CONT(o_totalprice, 0.25), 4) AS iqr,
        ROUND(SKEWNESS(o_totalprice), 6) AS skew, ROUND(KURTOSIS(o_totalprice), 6) AS kurt FROM orders""",
)
def _(t):
    df = profile.distribution(t["orders"], "o_totalprice")
    digits = {c: F.round(c, 4) for c in ("mean", "std", "p25", "median", "p75", "p95", "iqr")}
    return df.withColumns({**digits, "skew": F.round("skew", 6), "kurt": F.round("kurt", 6)})
