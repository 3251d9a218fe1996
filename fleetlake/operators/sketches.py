"""Sketch columns: quantiles (KLL) and distinct counts (HyperLogLog) that are stored and merged later.

A sketch of a group is a few kilobytes however many rows it has, is built per task before the shuffle, and
the sketches of two groups give the sketch of both. So months are sketched once, stored, and every coarser
level (quarters, ROLLUP, CUBE, any range of months) merges stored rows instead of reading the facts again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators import scale
from fleetlake.operators.sets import union_all

QUANTILE_K = 400  # a rank error of 0.7 %
DISTINCT_LG = 14  # a relative standard error of 0.8 %
_COUNTABLE = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def rank_error(k: int = QUANTILE_K) -> float:
    """Share of ranks by which a quantile of one KLL sketch may be off, at 99 % confidence; merging keeps it."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / 2 ** (lg / 2)


def _number(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def sketches(
    df: DataFrame, keys: Sequence[str], quantiles: Mapping[str, str], distinct: Mapping[str, str] | None = None, k: int = QUANTILE_K, lg: int = DISTINCT_LG
) -> DataFrame:
    """One row per group: ``keys``, row_count and for each named column its sketches.

    ``quantiles`` and ``distinct`` map a name to a column. ``<name>_kll`` comes with <name>_n, <name>_min and <name>_max of
    the values that are neither NULL nor NaN; ``<name>_hll`` counts values that are not NULL.
    """
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for name, c in quantiles.items():
        v = _number(c)
        aggs += [F.kll_sketch_agg_double(v, k).alias(f"{name}_kll"), F.count(v).alias(f"{name}_n"), F.min(v).alias(f"{name}_min"), F.max(v).alias(f"{name}_max")]
    for name, c in (distinct or {}).items():
        v = F.col(c) if isinstance(df.schema[c].dataType, _COUNTABLE) else F.col(c).cast("string")
        aggs.append(F.hll_sketch_agg(v, lg).alias(f"{name}_hll"))
    return df.groupBy(*keys).agg(*aggs)


def month_sketches(df: DataFrame, ts: str, keys: Sequence[str], quantiles: Mapping[str, str], distinct: Mapping[str, str] | None = None, k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """``sketches`` per group and calendar month of ``ts`` (column ``month``); rows without a date have a NULL month."""
    return sketches(df.withColumn("month", F.trunc(F.col(ts), "month")), ["month", *keys], quantiles, distinct, k, lg)


def merge(sketched: DataFrame, keys: Sequence[str], levels: str = "group") -> DataFrame:
    """Sketch rows merged to ``keys``; ``levels`` is group, rollup or cube.

    Only sketch rows are multiplied by the levels. ROLLUP and CUBE add ``level``, the grouping id: a key whose
    bit is set is summed over, which tells a total from a group whose key is NULL.
    """
    aggs = [F.sum("row_count").alias("row_count")]
    for c in sketched.columns:
        name = c[:-4]
        if c.endswith("_kll"):
            aggs += [F.kll_merge_agg_double(c).alias(c), F.sum(f"{name}_n").alias(f"{name}_n"), F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
        elif c.endswith("_hll"):
            aggs.append(F.hll_union_agg(c).alias(c))
    if levels == "group":
        return sketched.groupBy(*keys).agg(*aggs)
    grouped = {"rollup": sketched.rollup, "cube": sketched.cube}[levels](*keys)
    return grouped.agg(*aggs, F.grouping_id().alias("level"))


def quantile(name: str, p: float) -> Column:
    """The ``p``-quantile from ``<name>_kll``; NULL for a group without values, the exact extremes at 0 and 1."""
    if p in (0, 1):
        return F.col(f"{name}_{'max' if p else 'min'}")
    return F.when(F.col(f"{name}_n") > 0, F.kll_sketch_get_quantile_double(f"{name}_kll", F.lit(float(p))))


def rank(name: str, value: Column, steps: int = 1000) -> Column:
    """Share of the group's values that are at most ``value``, in steps of 1 / ``steps``.

    Spark's own rank function takes constants only; here the sketch's quantiles are compared with the row's value.
    """
    grid = F.kll_sketch_get_quantile_double(f"{name}_kll", F.array(*[F.lit((i + 0.5) / steps) for i in range(steps)]))
    return F.when(F.col(f"{name}_n") > 0, F.size(F.filter(grid, lambda q: q <= value)) / steps)


def distinct(name: str) -> Column:
    return F.hll_sketch_estimate(f"{name}_hll")


def distinct_cube(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact distinct counts (``name``) of a column on every level of CUBE over ``keys``, with ``level`` as in ``merge``.

    Rows become one per value with the groups it occurs in, and every level counts values from those: the facts are not
    multiplied by the levels. Groups without values have no row. A value lists at most as many groups as the finest level has.
    """
    per_value = df.where(F.col(column).isNotNull()).select(*keys, column).distinct().groupBy(column).agg(F.collect_list(F.struct(*keys)).alias("_groups"))

    def seen_on(level: int) -> Column:
        own = [not level >> (len(keys) - 1 - i) & 1 for i in range(len(keys))]
        return F.array_distinct(F.transform("_groups", lambda g: F.struct(
            *[(g[c] if kept else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c, kept in zip(keys, own)], F.lit(level).cast("bigint").alias("level")
        )))

    parts = [seen_on(level) for level in range(1 << len(keys))]
    groups = per_value.select(F.inline(F.flatten(F.array(*parts))))
    return groups.groupBy(*keys, "level").agg(F.count(F.lit(1)).alias(name))


def fences(sketched: DataFrame, name: str, reach: float = 1.5) -> DataFrame:
    """Quartiles and outlier fences from sketches, with the estimated share of values beyond them."""
    q = sketched.withColumns({"q1": quantile(name, 0.25), "median": quantile(name, 0.5), "q3": quantile(name, 0.75)})
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lower_fence": F.col("q1") - reach * iqr, "upper_fence": F.col("q3") + reach * iqr})
    return q.withColumn("beyond_share", rank(name, F.col("lower_fence")) + 1 - rank(name, F.col("upper_fence")))


def profile_sketches(df: DataFrame, k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """One row per column from a single scan: nulls, distinct values and, for numbers, extremes, quartiles and tails."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    plain, back = df.toDF(*[f"c{i}" for i in range(len(df.columns))]), dict(zip(df.columns, (f"c{i}" for i in range(len(df.columns)))))
    own = {back[c]: back[c] for c in numeric}
    one = sketches(plain, [], own, {c: c for c in back.values()}, k, lg)
    nulls = plain.agg(*[F.count(c).alias(f"{c}_filled") for c in back.values()])
    one = one.withColumns({f"{c}_filled": nulls.select(f"{c}_filled").scalar() for c in back.values()})
    cells = []
    for c, p in back.items():
        def at(x: float, p=p, c=c) -> Column:
            return quantile(p, x) if c in numeric else F.lit(None).cast("double")

        cells.append(F.struct(
            F.lit(c).alias("column_name"), F.col("row_count"), (F.col("row_count") - F.col(f"{p}_filled")).alias("nulls"), distinct(p).alias("distinct_values"),
            at(0).alias("lowest"), at(0.25).alias("p25"), at(0.5).alias("median"), at(0.75).alias("p75"), at(0.95).alias("p95"), at(0.99).alias("p99"), at(1).alias("highest"),
        ))
    return one.select(F.inline(F.array(*cells)))


def exact_ranks(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, names: Sequence[str]) -> DataFrame:
    """``estimates`` with ``<name>_below`` and ``<name>_upto`` for each estimate column: the exact shares of values less than, and at most, it.

    Reads the facts once more, for checks of sketches: the quantile of rank p is right if p lies between both.
    """
    v = df.select(*keys, _number(value).alias("_v")).where("_v is not null")
    if keys:
        joined = scale.same_key_join(v, estimates.select(*keys, *names), keys)
        group = list(keys)
    else:
        one = estimates.select(F.struct(*names).alias("s")).scalar()
        joined, group = v.withColumns({n: one.getField(n) for n in names}), []
    n = F.count(F.lit(1))
    shares = [x for c in names for x in ((F.count(F.when(F.col("_v") < F.col(c), 1)) / n).alias(f"{c}_below"), (F.count(F.when(F.col("_v") <= F.col(c), 1)) / n).alias(f"{c}_upto"))]
    return joined.groupBy(*group).agg(n.alias("n"), *shares)


def checked_levels(
    df: DataFrame, merged: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], value: str, name: str, probs: Mapping[str, float], error: float
) -> DataFrame:
    """Per group of each grouping set: n and, for each named quantile of the sketch, whether its exact rank is within ``error``.

    ``merged`` comes from ``merge(..., "rollup" or "cube")`` over ``keys``.
    """
    parts = []
    for chosen in sets:
        level = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in chosen)
        own = merged.where(F.col("level") == level).select(*chosen, *[quantile(name, p).alias(c) for c, p in probs.items()])
        ranks = exact_ranks(df, chosen, value, own, list(probs))
        ok = [((F.col(f"{c}_below") - error <= p) & (F.col(f"{c}_upto") + error >= p)).alias(f"{c}_within") for c, p in probs.items()]
        missing = [F.lit(None).cast(df.schema[c].dataType).alias(c) if c not in chosen else F.col(c) for c in keys]
        parts.append(ranks.select(*missing, F.lit(level).alias("level"), "n", *ok))
    return union_all(*parts)
