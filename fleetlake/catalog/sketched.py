"""Sketch columns on the sample tables.

KLL sketches draw random numbers, so their quantiles differ between runs. The queries report whether the exact rank of
each quantile lies within twice the sketch's error at 99 % confidence (about five standard deviations) and
distinct counts within five standard errors; the checking SQL expects every one to be, beside the exact counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.registry import CI, M, query
from fleetlake.catalog.relational import CUTOFF
from fleetlake.operators import scale, sketches
from fleetlake.session import scratch_path
from fleetlake.warehouse import load

_PROBS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
_WITHIN = ", ".join(f"TRUE AS {c}_within" for c in _PROBS)
_OK = 2 * sketches.rank_error()


def _stored(t):
    """Monthly sketches of the lines, written once; what the queries merge."""
    path = scratch_path(t.spark, "month-sketches")
    made = sketches.month_sketches(t["lineitem"], "l_shipdate", ["l_returnflag", "l_linestatus"], {"price": "l_extendedprice"}, {"parts": "l_partkey", "suppliers": "l_suppkey"})
    made.write.parquet(path)
    return t.spark.read.schema(made.schema).parquet(path)


@query(
    "sketch_rollup",
    f"""SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag) * 2 + GROUPING(l_linestatus) AS INTEGER) AS level, COUNT(*) AS n, {_WITHIN}
        FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def _(t):
    keys = ["l_returnflag", "l_linestatus"]
    merged = sketches.merge(_stored(t), keys, "rollup")
    return sketches.checked_levels(t["lineitem"], merged, keys, [keys, keys[:1], []], "l_extendedprice", "price", _PROBS, _OK)


@query(
    "sketch_cube",
    f"""SELECT CAST(y AS INTEGER) AS y, l_returnflag, CAST(GROUPING(y) * 2 + GROUPING(l_returnflag) AS INTEGER) AS level, COUNT(*) AS n, {_WITHIN}
        FROM (SELECT EXTRACT(year FROM l_shipdate) AS y, l_returnflag FROM lineitem) GROUP BY CUBE (y, l_returnflag)""",
)
def _(t):
    keys = ["y", "l_returnflag"]
    merged = sketches.merge(_stored(t).withColumn("y", F.year("month")), keys, "cube")
    facts = t["lineitem"].withColumn("y", F.year("l_shipdate"))
    return sketches.checked_levels(facts, merged, keys, [keys, keys[:1], keys[1:], []], "l_extendedprice", "price", _PROBS, _OK)


@query(
    "sketch_distinct",
    """SELECT l_returnflag, CAST(y AS INTEGER) AS y, CAST(GROUPING(l_returnflag) * 2 + GROUPING(y) AS INTEGER) AS level, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers,
        TRUE AS parts_within, TRUE AS suppliers_within FROM (SELECT *, EXTRACT(year FROM l_shipdate) AS y FROM lineitem) GROUP BY CUBE (l_returnflag, y)""",
)
def _(t):
    # distinct counts do not add up over months; merged sketches do. The exact counts are here to check them
    keys = ["l_returnflag", "y"]
    merged = sketches.merge(_stored(t).withColumn("y", F.year("month")), keys, "cube")
    facts = t["lineitem"].withColumn("y", F.year("l_shipdate"))
    both = merged.select(*keys, "level", sketches.distinct("parts").alias("p"), sketches.distinct("suppliers").alias("s"))
    for name, column in {"parts": "l_partkey", "suppliers": "l_suppkey"}.items():
        both = scale.same_key_join(both, sketches.distinct_cube(facts, keys, column, name), [*keys, "level"], "left")
        both = both.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    bound = 5 * sketches.distinct_error()
    return both.select(
        *keys, F.col("level").cast("int").alias("level"), "parts", "suppliers", (F.abs(F.col("p") - F.col("parts")) <= bound * F.col("parts")).alias("parts_within"), (F.abs(F.col("s") - F.col("suppliers")) <= bound * F.col("suppliers")).alias("suppliers_within")
    )


@query(
    "sketch_refresh",
    f"""SELECT {M('o_orderdate')}::VARCHAR AS month, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS customers, TRUE AS median_within, TRUE AS customers_within,
        BOOL_OR(o_orderdate >= TIMESTAMP '{CUTOFF}' AND o_orderkey % 3 = 0) AS made_again FROM orders GROUP BY {M('o_orderdate')}""",
)
def _(t):
    # the first load lacks every third order of the last months; when those arrive, only their months are sketched again
    path, orders = scratch_path(t.spark, "refreshed"), t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    late = (F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp")) & (F.col("o_orderkey") % 3 == 0)

    def made(df, run):
        return sketches.month_sketches(df, "o_orderdate", [], {"price": "o_totalprice"}, {"customers": "o_custkey"}).withColumn("run", F.lit(run))

    load.write_months(made(orders.where(~late), 1), path, "month")
    months = orders.where(late).select(F.trunc("o_orderdate", "month").alias("m")).distinct()
    touched = orders.withColumn("m", F.trunc("o_orderdate", "month")).join(months, "m", "left_semi")
    load.write_months(made(touched, 2), path, "month")
    stored = t.spark.read.parquet(path)
    own = orders.withColumn("month", F.trunc("o_orderdate", "month"))
    ranks = sketches.exact_ranks(own, ["month"], "o_totalprice", stored.select("month", sketches.quantile("price", 0.5).alias("median")), ["median"])
    exact = own.groupBy("month").agg(F.count_distinct("o_custkey").alias("customers"))
    joined = stored.select("month", "run", sketches.distinct("customers").alias("c")).join(ranks, "month").join(exact, "month")
    return joined.select(
        "month", "n", "customers", ((F.col("median_below") - _OK <= 0.5) & (F.col("median_upto") + _OK >= 0.5)).alias("median_within"),
        (F.abs(F.col("c") - F.col("customers")) <= 5 * sketches.distinct_error() * F.col("customers")).alias("customers_within"), (F.col("run") == 2).alias("made_again"),
    )


@query(
    "sketch_outliers",
    """SELECT l_returnflag, COUNT(*) AS row_count, TRUE AS q1_within, TRUE AS median_within, TRUE AS q3_within, TRUE AS share_within FROM lineitem GROUP BY 1""",
)
def _(t):
    merged = sketches.fences(sketches.merge(_stored(t), ["l_returnflag"]), "price")
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    ranks = sketches.exact_ranks(t["lineitem"], ["l_returnflag"], "l_extendedprice", merged, [*names, "lower_fence", "upper_fence"])
    both = ranks.join(merged.select("l_returnflag", "row_count", "beyond_share"), "l_returnflag")
    ok = [((F.col(f"{c}_below") - _OK <= p) & (F.col(f"{c}_upto") + _OK >= p)).alias(f"{c}_within") for c, p in names.items()]
    # the share beyond two fences is off by two ranks and their steps at most
    exact = F.col("lower_fence_below") + 1 - F.col("upper_fence_upto")
    return both.select("l_returnflag", "row_count", *ok, (F.abs(F.col("beyond_share") - exact) <= 2 * _OK + 0.002).alias("share_within"))


_COLUMNS = {"l_partkey": 1, "l_suppkey": 1, "l_quantity": 1, "l_extendedprice": 1, "l_returnflag": 0, "l_shipdate": 0}


@query(
    "sketch_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, {CI(f'{c} IS NULL')} AS nulls, {f'CAST(MIN({c}) AS DOUBLE)' if num else 'NULL'} AS lowest, {f'CAST(MAX({c}) AS DOUBLE)' if num else 'NULL'} AS highest, COUNT(DISTINCT {c}) AS distinct_values, TRUE AS distinct_within, "
        f"{'TRUE' if num else 'NULL'} AS quantiles_within FROM lineitem"
        for c, num in _COLUMNS.items()
    ),
)
def _(t):
    lines = t["lineitem"].select(*_COLUMNS)
    made = sketches.profile_sketches(lines)
    stored_path = scratch_path(t.spark, "profile-sketches")
    made.write.parquet(stored_path)
    made = t.spark.read.schema(made.schema).parquet(stored_path)
    quarter = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    parts = []
    for c, num in _COLUMNS.items():
        own = made.where(F.col("column_name") == c)
        ok = F.lit(None).cast("boolean")
        if num:
            ranks = sketches.exact_ranks(lines, [], c, own.select(*quarter), list(quarter))
            every = F.lit(True)
            for q, p in quarter.items():
                every = every & (F.col(f"{q}_below") - _OK <= p) & (F.col(f"{q}_upto") + _OK >= p)
            ok = ranks.select(every.alias("ok")).scalar()
        exact = lines.agg(F.count_distinct(c).alias("d")).scalar()
        near = F.abs(F.col("distinct_values") - exact) <= 5 * sketches.distinct_error() * exact
        parts.append(own.select("column_name", "row_count", "nulls", "lowest", "highest", exact.alias("distinct_values"), near.alias("distinct_within"), ok.alias("quantiles_within")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
