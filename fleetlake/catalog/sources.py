"""Sources, sinks and scalar function families on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.adapters import AS_OF, BASE_TABLES, FOREIGN_KEYS, PRIMARY_KEYS
from fleetlake.catalog.registry import A, D, S, TS, query
from fleetlake.functions import scalar as fn
from fleetlake.operators import joins
from fleetlake.session import scratch_path
from fleetlake.sources import sinks, tables


@query("load_table", f"SELECT p_brand, COUNT(*) AS row_count, {S('p_retailprice')} AS total_price FROM part GROUP BY 1")
def _(t):
    df = tables.load_table(t.spark, t.root, "part")
    return df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("row_count"), fn.dsum("p_retailprice").alias("total_price"))


@query("load_all", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in sorted(BASE_TABLES)))
def _(t):
    return tables.table_row_counts(tables.load_all(t.spark, t.root, BASE_TABLES))


@query(
    "normalise_dates",
    """SELECT EXTRACT(year FROM o_orderdate) AS year, COUNT(o_orderdate) AS parsed, CAST(0 AS BIGINT) AS failed FROM orders GROUP BY 1""",
)
def _(t):
    text = t["orders"].select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"))
    df = tables.normalise_dates(text, ["stamp"])
    return df.groupBy(F.year("stamp").cast("bigint").alias("year")).agg(
        F.count("stamp").alias("parsed"), F.count(F.when(F.col("stamp").isNull(), 1)).alias("failed")
    )


@query(
    "derive_calendar",
    """SELECT EXTRACT(year FROM ts) AS year, STRFTIME(ts, '%Y-%m') AS month,
        STRFTIME(DATE_TRUNC('week', ts), '%Y-%m-%d') || '/' || STRFTIME(DATE_TRUNC('week', ts) + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
        EXTRACT(hour FROM ts) AS hour, DAYNAME(ts) AS dow, EXTRACT(isodow FROM ts) >= 6 AS is_weekend, COUNT(*) AS row_count
    FROM events GROUP BY ALL""",
)
def _(t):
    df = tables.derive_calendar(t["events"], "ts")
    keys = [F.col("year").cast("bigint"), "month", "week", F.col("hour").cast("bigint").alias("hour"), "dow", "is_weekend"]
    keys[0] = keys[0].alias("year")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "raw_csv_view",
    "SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(t):
    folder = scratch_path(t.spark, "raw")
    frames = {n: t[n] for n in ("nation", "region")}
    views = {}
    for name, df in frames.items():
        df.write.option("header", True).csv(f"{folder}/{name}")
        views[name] = tables.raw_csv_view(t.spark, f"{folder}/{name}", df.schema, f"raw_{name}")
    return t.spark.sql("SELECT n_nationkey, n_name, n_regionkey, r_name FROM raw_nation JOIN raw_region ON n_regionkey = r_regionkey")


@query("register_tables", "SELECT c_mktsegment, COUNT(*) AS order_count FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def _(t):
    tables.register_tables({f"reg_{n}": t[n] for n in ("customer", "orders")})
    return t.spark.sql(
        "SELECT c_mktsegment, COUNT(*) AS order_count FROM reg_customer JOIN reg_orders ON c_custkey = o_custkey GROUP BY 1"
    )


@query("sql_query", f"SELECT o_orderstatus, COUNT(*) AS n, {S('o_totalprice')} AS total FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def _(t):
    return tables.sql_query(
        t.spark,
        "SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total "
        "FROM {orders} WHERE o_totalprice > :floor GROUP BY o_orderstatus",
        {"floor": 100000},
        orders=t["orders"],
    )


@query("write_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t):
    root = scratch_path(t.spark, "tables")
    sinks.write_table(t["supplier"], root, "supplier", "s_suppkey")
    return t.spark.read.parquet(f"{root}/parquet/supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("report_sheets", f"SELECT payment_method, {S('total_amount')} AS billed FROM invoices GROUP BY 1")
def _(t):
    root = scratch_path(t.spark, "report")
    inv = t["invoices"]
    sheets = {
        "by_method": inv.groupBy("payment_method").agg(fn.dsum("total_amount").alias("billed")),
        "by_status": inv.groupBy("payment_status").agg(fn.dsum("total_amount").alias("billed")),
    }
    paths = sinks.report_sheets(sheets, root)
    return t.spark.read.parquet(paths[0])


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in BASE_TABLES))
def _(t):
    return tables.table_row_counts({n: t[n] for n in BASE_TABLES})


# The engines' names of the types that occur.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp", "DATE": "date", "BOOLEAN": "boolean", "FLOAT[]": "array<float>", "DOUBLE[]": "array<double>"}


def _inventory_sql():
    kind = "CASE column_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPES.items()) + " END"
    parts = []
    for name in BASE_TABLES:
        tags = [(c, "PK") for c in PRIMARY_KEYS.get(name, ())] + [(c, "FK") for c in FOREIGN_KEYS.get(name, ()) if c not in PRIMARY_KEYS.get(name, ())]
        tag = "CASE column_name " + " ".join(f"WHEN '{c}' THEN '{k}'" for c, k in tags) + " ELSE '' END" if tags else "''"
        parts.append(f"SELECT '{name}' AS table_name, CAST(ROW_NUMBER() OVER () AS INTEGER) AS position, column_name, {kind} AS column_type, {tag} AS key_tag, (SELECT COUNT(*) FROM {name}) AS row_count FROM (DESCRIBE {name})")
    return " UNION ALL ".join(parts)


@query("table_inventory", _inventory_sql())
def _(t):
    return tables.table_inventory({n: t[n] for n in BASE_TABLES}, PRIMARY_KEYS, FOREIGN_KEYS)


@query("preview", "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 50")
def _(t):
    return tables.preview(t["customer"].select("c_custkey", "c_name", "c_mktsegment"), 50, "c_custkey")


@query(
    "json_extract",
    "SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1",
)
def _(t):
    k = tables.json_field("props", "$.k").try_cast("bigint")
    return t["events"].groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k_sum"))


# --- scalar families ---


@query(
    "fn_date",
    f"""SELECT event_id, EXTRACT(year FROM ts) AS y, EXTRACT(month FROM ts) AS m, EXTRACT(day FROM ts) AS d,
        EXTRACT(hour FROM ts) AS h, EXTRACT(isodow FROM ts) - 1 AS dow, {D("DATE_TRUNC('month', ts)")} AS month_first,
        {D("DATE_TRUNC('week', ts)")} AS week_first, DATE_DIFF('hour', ts, TIMESTAMP '2024-02-01 00:00:00') AS hours_left,
        DATE_DIFF('day', ts, TIMESTAMP '2024-02-01 00:00:00') AS days_left,
        DATE_DIFF('month', ts, TIMESTAMP '2024-12-01 00:00:00') AS months_left,
        STRFTIME(ts, '%Y-%m') AS label, CAST(FLOOR(EPOCH(ts)) AS BIGINT) AS epoch_s, {TS("ts + INTERVAL 1 MONTH")} AS next_month
    FROM events""",
)
def _(t):
    end, late = F.lit("2024-02-01").cast("timestamp"), F.lit("2024-12-01").cast("timestamp")
    big = {"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts"), "h": F.hour("ts"), "dow": F.weekday("ts")}
    return t["events"].select(
        "event_id",
        *[c.cast("bigint").alias(n) for n, c in big.items()],
        fn.month_start("ts").alias("month_first"),
        F.to_date(F.date_trunc("week", "ts")).alias("week_first"),
        fn.hours_between("ts", end).alias("hours_left"),
        fn.days_between("ts", end).alias("days_left"),
        fn.months_between("ts", late).alias("months_left"),
        F.date_format("ts", "yyyy-MM").alias("label"),
        F.unix_timestamp("ts").alias("epoch_s"),
        (F.col("ts") + F.expr("INTERVAL '1' MONTH")).alias("next_month"),
    )


@query(
    "fn_string",
    r"""SELECT p_partkey, UPPER(p_name) AS up, LOWER(p_brand) AS low,
        UPPER(SUBSTR(p_name, 1, 1)) || LOWER(SUBSTR(SPLIT_PART(p_name, ' ', 1), 2)) AS first_word, TRIM('  ' || p_name || ' ') AS trimmed,
        LTRIM('  ' || p_name) AS ltrimmed, RTRIM(p_name || '  ') AS rtrimmed, SPLIT_PART(p_name, ' ', 2) AS second_word,
        CAST(LENGTH(p_name) AS INTEGER) AS len, CAST(POSITION('a' IN p_name) AS INTEGER) AS a_at, SUBSTR(p_name, 2, 3) AS mid, REPLACE(p_name, ' ', '_') AS snake,
        REGEXP_REPLACE(p_brand, '[^0-9]', '', 'g') AS digits, p_brand || '/' || p_name AS joined, p_name LIKE '%ring%' AS has_ring
    FROM part""",
)
def _(t):
    name = F.col("p_name")
    return t["part"].select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower("p_brand").alias("low"),
        F.initcap(F.split_part(name, F.lit(" "), F.lit(1))).alias("first_word"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), name)).alias("ltrimmed"),
        F.rtrim(F.concat(name, F.lit("  "))).alias("rtrimmed"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second_word"),
        F.length(name).alias("len"),
        F.position(F.lit("a"), name).alias("a_at"),
        F.substring(name, 2, 3).alias("mid"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("snake"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"),
        F.concat_ws("/", "p_brand", "p_name").alias("joined"),
        name.like("%ring%").alias("has_ring"),
    )


@query(
    "fn_null",
    """SELECT p_partkey, COALESCE(NULLIF(p_type, 'ECONOMY'), 'none') AS kind, NULLIF(p_size % 3, 0) AS rest,
        IFNULL(NULLIF(p_brand, 'Brand#1'), 'first') AS brand, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class
    FROM part""",
)
def _(t):
    return t["part"].select(
        "p_partkey",
        F.coalesce(F.nullif("p_type", F.lit("ECONOMY")), F.lit("none")).alias("kind"),
        F.nullif(F.col("p_size") % 3, F.lit(0)).alias("rest"),
        F.ifnull(F.nullif("p_brand", F.lit("Brand#1")), F.lit("first")).alias("brand"),
        F.when(F.col("p_size") > 25, "large").otherwise("small").alias("size_class"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, ABS(c_acctbal) AS magnitude, GREATEST(c_acctbal, 0) AS positive, LEAST(c_acctbal, 5000) AS capped,
        GREATEST(0, LEAST(100, c_acctbal / 50)) AS clipped, ROUND(CAST(c_acctbal AS DECIMAL(18,4)), 0)::DOUBLE AS whole,
        ROUND(SQRT(ABS(c_acctbal)), 9) AS root, ROUND(RADIANS(c_acctbal), 9) AS rad, ROUND(SIN(RADIANS(c_acctbal)), 9) AS sine,
        ROUND(COS(RADIANS(c_acctbal)), 9) AS cosine, ROUND(ATAN2(c_acctbal, 100), 9) AS angle
    FROM customer""",
)
def _(t):
    b = F.col("c_acctbal")
    return t["customer"].select(
        "c_custkey",
        F.abs(b).alias("magnitude"),
        F.greatest(b, F.lit(0.0)).alias("positive"),
        F.least(b, F.lit(5000.0)).alias("capped"),
        fn.clip(b / 50, 0.0, 100.0).alias("clipped"),
        F.round(fn.money(b), 0).cast("double").alias("whole"),
        F.round(F.sqrt(F.abs(b)), 9).alias("root"),
        F.round(F.radians(b), 9).alias("rad"),
        F.round(F.sin(F.radians(b)), 9).alias("sine"),
        F.round(F.cos(F.radians(b)), 9).alias("cosine"),
        F.round(F.atan2(b, F.lit(100.0)), 9).alias("angle"),
    )


@query(
    "fn_cast",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, TRY_CAST(p_type AS INTEGER) AS not_a_number,
        TRY_CAST(REPLACE(p_brand, 'Brand#', '') AS INTEGER) AS brand_no, CAST(p_retailprice AS DECIMAL(18,4))::DOUBLE AS price
    FROM part""",
)
def _(t):
    return t["part"].select(
        "p_partkey",
        F.col("p_size").cast("string").alias("size_text"),
        F.col("p_type").try_cast("int").alias("not_a_number"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("int").alias("brand_no"),
        fn.money("p_retailprice").cast("double").alias("price"),
    )


@query(
    "fn_haversine",
    """WITH places AS (SELECT c_custkey, 24.0 + c_nationkey * 0.5 AS lat1, 66.0 + c_nationkey * 0.3 AS lon1 FROM customer)
    SELECT c_custkey, ROUND(6371.0 * 2 * ATAN2(SQRT(a), SQRT(1 - a)), 6) AS km FROM (
        SELECT c_custkey, POW(SIN(RADIANS(31.5204 - lat1) / 2), 2)
            + COS(RADIANS(lat1)) * COS(RADIANS(31.5204)) * POW(SIN(RADIANS(74.3587 - lon1) / 2), 2) AS a FROM places)""",
)
def _(t):
    k = F.col("c_nationkey")
    km = fn.haversine_km(24.0 + k * 0.5, 66.0 + k * 0.3, F.lit(31.5204), F.lit(74.3587))
    return t["customer"].select("c_custkey", F.round(km, 6).alias("km"))


@query(
    "fn_mask_format",
    """SELECT s_suppkey, 'SP' || LPAD(CAST(s_suppkey AS VARCHAR), GREATEST(6, LENGTH(CAST(s_suppkey AS VARCHAR)))::INTEGER, '0') AS code,
        CASE WHEN s_acctbal >= 1000 THEN 'PKR ' || CAST(CAST(ROUND(CAST(s_acctbal / 1000 AS DECIMAL(18,6)), 0) AS BIGINT) AS VARCHAR) || 'K'
             ELSE 'PKR ' || CAST(CAST(ROUND(CAST(s_acctbal AS DECIMAL(18,4)), 0) AS BIGINT) AS VARCHAR) END AS label
    FROM supplier""",
)
def _(t):
    return t["supplier"].select(
        "s_suppkey", fn.make_id("SP", "s_suppkey", 6).alias("code"), fn.money_label("s_acctbal").alias("label")
    )


@query(
    "case_bucket",
    f"""SELECT bucket, COUNT(*) AS n, {A('o_totalprice')} AS avg_price FROM (
        SELECT o_totalprice, CASE WHEN age <= 30 THEN '0-30' WHEN age <= 180 THEN '31-180' WHEN age <= 365 THEN '181-365' ELSE '365+' END AS bucket
        FROM (SELECT o_totalprice, DATE_DIFF('day', o_orderdate, TIMESTAMP '{AS_OF}') AS age FROM orders)) GROUP BY 1""",
)
def _(t):
    age = fn.days_between("o_orderdate", F.lit(AS_OF).cast("timestamp"))
    bucket = fn.case_bucket(age, [30, 180, 365], ["0-30", "31-180", "181-365", "365+"])
    return t["orders"].groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), fn.davg("o_totalprice").alias("avg_price"))


@query(
    "cut_bucket",
    """SELECT band, COUNT(*) AS n FROM (SELECT CASE WHEN o_totalprice <= 0 THEN NULL WHEN o_totalprice <= 50000 THEN 'low'
        WHEN o_totalprice <= 100000 THEN 'mid' WHEN o_totalprice <= 200000 THEN 'high' END AS band FROM orders) GROUP BY 1""",
)
def _(t):
    band = fn.cut("o_totalprice", [0, 50_000, 100_000, 200_000], ["low", "mid", "high"])
    return t["orders"].groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("clip", "SELECT event_id, GREATEST(10, LEAST(50, value)) AS clipped FROM events")
def _(t):
    return t["events"].select("event_id", fn.clip("value", 10.0, 50.0).alias("clipped"))


@query(
    "safe_ratio",
    f"SELECT l_orderkey, {S('l_extendedprice')} / NULLIF({S('l_tax')}, 0) AS price_per_tax FROM lineitem GROUP BY 1",
)
def _(t):
    return t["lineitem"].groupBy("l_orderkey").agg(fn.ratio(fn.dsum("l_extendedprice"), fn.dsum("l_tax")).alias("price_per_tax"))
