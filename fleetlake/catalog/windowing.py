"""Window operators on the sample tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.catalog.registry import A, D, M, P, S, TS, query
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import davg, dsum, pct, rows
from fleetlake.operators import scale, windows
from fleetlake.operators.aggregates import share_of_total
from fleetlake.operators.sets import dedup_latest
from fleetlake.session import materialise

BY_CUSTOMER = ["o_custkey"]
BY_DATE = ["o_orderdate", "o_orderkey"]


def monthly_orders(t, *keys):
    return t["orders"].groupBy(*keys, fn.month_start("o_orderdate").alias("month")).agg(
        rows().alias("n"), dsum("o_totalprice").alias("revenue")
    )


def daily_orders(t):
    return t["orders"].groupBy(F.to_date("o_orderdate").alias("day")).agg(rows().alias("n"), dsum("o_totalprice").alias("revenue"))


_MONTHLY = f"(SELECT {M('o_orderdate')} AS month, COUNT(*) AS n, {S('o_totalprice')} AS revenue FROM orders GROUP BY 1)"
_DAILY = f"(SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, {S('o_totalprice')} AS revenue FROM orders GROUP BY 1)"


@query("win_row_number", "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders")
def _(t):
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return scale.row_number(o, BY_CUSTOMER, BY_DATE, "seq").drop("o_orderdate")


@query(
    "win_rank_dense",
    f"""SELECT n_name, l_suppkey, revenue, RANK() OVER (PARTITION BY n_name ORDER BY revenue DESC) AS revenue_rank,
        DENSE_RANK() OVER (PARTITION BY n_name ORDER BY revenue DESC) AS dense_pos FROM (
        SELECT n_name, l_suppkey, {S('l_extendedprice')} AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)""",
)
def _(t):
    rev = t["lineitem"].groupBy("l_suppkey").agg(dsum("l_extendedprice").alias("revenue"))
    df = rev.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    df = materialise(df.select("n_name", "l_suppkey", "revenue"), "supplier-revenue")
    return scale.ranks(df, ["n_name"], "-revenue", rank="revenue_rank", dense="dense_pos")


@query(
    "win_ntile",
    """SELECT o_orderkey, quartile, decile, CASE quartile WHEN 1 THEN 'Budget' WHEN 2 THEN 'Economy' WHEN 3 THEN 'Standard' ELSE 'Premium' END AS tier
        FROM (SELECT o_orderkey, NTILE(4) OVER (ORDER BY o_totalprice, o_orderkey) AS quartile, NTILE(10) OVER (ORDER BY o_totalprice, o_orderkey) AS decile FROM orders)""",
)
def _(t):
    o = t["orders"].select("o_orderkey", "o_totalprice")
    df = scale.ntile(o, [], ["o_totalprice", "o_orderkey"], {"quartile": 4, "decile": 10})
    tiers = F.array(*[F.lit(x) for x in ("Budget", "Economy", "Standard", "Premium")])
    return df.withColumn("tier", F.element_at(tiers, F.col("quartile").cast("int"))).drop("o_totalprice")


@query(
    "win_percent_rank",
    "SELECT o_orderkey, PERCENT_RANK() OVER (ORDER BY o_totalprice) AS pr, CUME_DIST() OVER (ORDER BY o_totalprice) AS cd FROM orders",
)
def _(t):
    return scale.ranks(t["orders"].select("o_orderkey", "o_totalprice"), [], "o_totalprice", percent="pr", cume="cd").drop("o_totalprice")


@query(
    "win_lag_growth",
    f"""SELECT {D('month')} AS month, revenue, LAG(revenue) OVER (ORDER BY month) AS prev, revenue - LAG(revenue) OVER (ORDER BY month) AS change,
        {P('revenue - LAG(revenue) OVER (ORDER BY month)', 'LAG(revenue) OVER (ORDER BY month)')} AS change_pct FROM {_MONTHLY}""",
)
def _(t):
    return windows.growth(monthly_orders(t).drop("n"), [], "month", "revenue")


@query(
    "win_lead",
    f"""SELECT o_orderkey, o_custkey, {D('LEAD(o_orderdate) OVER w')} AS next_order, DATE_DIFF('day', o_orderdate, LEAD(o_orderdate) OVER w) AS gap_days
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t):
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    df = scale.bounded(o, BY_CUSTOMER, BY_DATE, {"nxt": lambda w: F.lead("o_orderdate").over(w)}, before=0, after=1)
    return df.select("o_orderkey", "o_custkey", F.to_date("nxt").alias("next_order"), fn.days_between("o_orderdate", "nxt").alias("gap_days"))


@query(
    "win_first_last",
    f"""SELECT DISTINCT o_custkey, {D('FIRST_VALUE(o_orderdate) OVER w')} AS first_order, {D('LAST_VALUE(o_orderdate) OVER w')} AS last_order,
        FIRST_VALUE(o_totalprice) OVER w AS first_price, LAST_VALUE(o_totalprice) OVER w AS last_price FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(t):
    # first and last of a group are aggregates, so partial aggregation applies
    at = F.struct("o_orderdate", "o_orderkey")
    return t["orders"].groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_order"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
        F.min_by("o_totalprice", at).alias("first_price"),
        F.max_by("o_totalprice", at).alias("last_price"),
    )


@query(
    "win_running_total",
    f"""SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) OVER w AS DOUBLE) AS running_total, COUNT(*) OVER w AS orders_so_far
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
)
def _(t):
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    df = scale.running(o, BY_CUSTOMER, BY_DATE, {"r": fn.money("o_totalprice"), "orders_so_far": F.lit(1).cast("bigint")})
    return df.select("o_orderkey", "o_custkey", F.col("r").cast("double").alias("running_total"), "orders_so_far")


@query(
    "win_running_by_range",
    """SELECT line_id, l_returnflag, ROW_NUMBER() OVER w AS seq, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) OVER w AS DOUBLE) AS running_total
        FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) 'LN' || LPAD(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS line_id, l_returnflag, l_extendedprice FROM staged_lineitem)
        WINDOW w AS (PARTITION BY l_returnflag ORDER BY line_id ROWS UNBOUNDED PRECEDING)""",
)
def _(t):
    # three groups hold all rows and the order is a text id: cut into ranges whatever the size
    line = F.concat(F.lit("LN"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit("-"), F.col("l_linenumber").cast("string"))
    df = t["staged_lineitem"].select(line.alias("line_id"), "l_returnflag", "l_extendedprice")
    split = scale.Split(df, ["l_returnflag"], ["line_id"], force=True)
    out = scale.running(df, ["l_returnflag"], ["line_id"], {"seq": F.lit(1).cast("bigint"), "r": fn.money("l_extendedprice")}, split=split)
    return out.select("line_id", "l_returnflag", "seq", F.col("r").cast("double").alias("running_total"))


_FRAMES = {"avg_3": 3, "avg_5": 5, "avg_7": 7, "avg_30": 30}


def _frame(n, extra="CURRENT ROW"):
    return f"OVER (ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND {extra})"


@query(
    "win_moving_avg",
    f"SELECT {D('day')} AS day, n, " + ", ".join(f"AVG(n) {_frame(k)} AS {c}" for c, k in _FRAMES.items()) + f", MAX(n) {_frame(6)} AS max_6 FROM {_DAILY}",
)
def _(t):
    c = F.col("n")
    return daily_orders(t).select(
        "day", "n", *[windows.rolling(c, "day", k).alias(name) for name, k in _FRAMES.items()], windows.rolling(c, "day", 6, fn=F.max).alias("max_6")
    )


@query("win_centered_avg", f"SELECT {D('day')} AS day, AVG(n) {_frame(2, '1 FOLLOWING')} AS centered FROM {_DAILY}")
def _(t):
    return daily_orders(t).select("day", windows.rolling(F.col("n"), "day", 2, ahead=1).alias("centered"))


@query("win_strict_rolling", f"SELECT {D('day')} AS day, CASE WHEN COUNT(*) {_frame(7)} = 7 THEN AVG(n) {_frame(7)} END AS mean_7 FROM {_DAILY}")
def _(t):
    return daily_orders(t).select("day", windows.rolling(F.col("n"), "day", 7, strict=True).alias("mean_7"))


@query(
    "win_ytd",
    f"""SELECT {D('month')} AS month, CAST(SUM(CAST(revenue AS DECIMAL(18,4))) OVER (PARTITION BY EXTRACT(year FROM month) ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS ytd FROM {_MONTHLY}""",
)
def _(t):
    w = Window.partitionBy(F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly_orders(t).select("month", F.sum(fn.wide_money("revenue")).over(w).cast("double").alias("ytd"))


@query(
    "win_share_of_total",
    f"SELECT fleet_id, {S('total_amount')} AS revenue, {S('total_amount')} * 100.0::DOUBLE / CAST(SUM(SUM(CAST(total_amount AS DECIMAL(18,4)))) OVER () AS DOUBLE) AS share_pct FROM fleet_invoices GROUP BY 1",
)
def _(t):
    m = t["fleet_invoices"].groupBy("fleet_id").agg(dsum("total_amount").alias("revenue"))
    return share_of_total(m, "revenue", "share_pct")


@query(
    "win_partition_avg",
    f"""SELECT o_orderkey, o_orderpriority, avg_price, o_totalprice / avg_price AS price_index FROM orders JOIN
        (SELECT o_orderpriority, {A('o_totalprice')} AS avg_price FROM orders GROUP BY 1) USING (o_orderpriority)""",
)
def _(t):
    o = t["orders"].select("o_orderkey", "o_orderpriority", "o_totalprice")
    mean = o.groupBy("o_orderpriority").agg(davg("o_totalprice").alias("avg_price"))
    df = o.join(mean, "o_orderpriority")
    return df.select("o_orderkey", "o_orderpriority", "avg_price", (F.col("o_totalprice") / F.col("avg_price")).alias("price_index"))


@query("win_qualify_top1", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def _(t):
    return dedup_latest(t["orders"].select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["-o_totalprice", "o_orderkey"])


@query(
    "win_sessionize",
    f"""SELECT user_id, session_id, {TS('MIN(ts)')} AS session_start, {TS('MAX(ts)')} AS session_end, COUNT(*) AS n FROM (
        SELECT *, CAST(SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
        FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)) GROUP BY 1, 2""",
)
def _(t):
    e = t["events"].select("user_id", "ts", "event_id")
    s = windows.sessionize(e, ["user_id"], "ts", "event_id", gap_seconds=12 * 3600)
    return s.groupBy("user_id", "session_id").agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), rows().alias("n"))


@query(
    "win_pareto",
    f"""WITH r AS (SELECT o_custkey, {S('o_totalprice')} AS revenue FROM orders GROUP BY 1),
        x AS (SELECT *, CAST(SUM(CAST(revenue AS DECIMAL(18,4))) OVER (ORDER BY revenue DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
            (SELECT {S('revenue')} FROM r) AS total FROM r)
        SELECT o_custkey, revenue, running_total, running_total * 100.0::DOUBLE / total AS cumulative_pct,
            CASE WHEN running_total * 100.0::DOUBLE / total <= 80 THEN 'Top 80%' ELSE 'Tail 20%' END AS pareto_group FROM x""",
)
def _(t):
    r = t["orders"].groupBy("o_custkey").agg(dsum("o_totalprice").alias("revenue"))
    return windows.pareto(r, "revenue", "o_custkey")


@query(
    "win_diff_fill",
    """SELECT o_orderkey, o_custkey, COALESCE(DATE_DIFF('day', LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate), 90) AS days_since_last FROM orders""",
)
def _(t):
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    df = scale.bounded(o, BY_CUSTOMER, BY_DATE, {"p": lambda w: F.lag("o_orderdate").over(w)})
    gap = F.coalesce(fn.days_between("p", "o_orderdate"), F.lit(90).cast("bigint"))
    return df.select("o_orderkey", "o_custkey", gap.alias("days_since_last"))


@query(
    "win_pct_change",
    f"""SELECT * FROM (SELECT {D('month')} AS month, revenue, {P('revenue - LAG(revenue) OVER (ORDER BY month)', 'LAG(revenue) OVER (ORDER BY month)')} AS growth_pct
        FROM {_MONTHLY}) ORDER BY month DESC LIMIT 12""",
)
def _(t):
    df = windows.growth(monthly_orders(t), [], "month", "revenue")
    return df.orderBy(F.desc("month")).limit(12).select("month", "revenue", F.col("change_pct").alias("growth_pct"))
