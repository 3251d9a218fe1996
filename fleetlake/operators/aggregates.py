"""Grouped summaries with columns and measures as parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.scalar import davg, dsum, pct, ratio, sum_if, wide_sum
from fleetlake.operators import scale


def basic_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Row count, sum, mean, minimum, maximum, sample deviation and variance."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        dsum(value).alias("total"),
        davg(value).alias("mean"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.round(F.stddev_samp(value), 4).alias("std_dev"),
        F.round(F.var_samp(value), 2).alias("variance"),
    )


def pivot_sum(df: DataFrame, rows: Sequence[str], column: Column, values: Sequence, measure: Column, prefix: str = "", other: str | None = None) -> DataFrame:
    """Sum of ``measure`` per row group with one output column per listed value, zeros filled.

    ``other`` names a column for all values that are not listed, so nothing is left out.
    """
    cols = [
        sum_if(column == F.lit(v), measure).alias(f"{prefix}{v}") for v in values
    ]
    if other:
        cols.append(sum_if(~column.isin(*values), measure).alias(other))
    return df.groupBy(*rows).agg(*cols)


def pivot_count(df: DataFrame, rows: Sequence[str], column: Column, values: Sequence, prefix: str = "") -> DataFrame:
    """Count per row group with one output column per listed value."""
    return df.groupBy(*rows).agg(*[F.count(F.when(column == F.lit(v), 1)).alias(f"{prefix}{v}") for v in values])


def value_counts(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    """Frequency per value with its share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return share_of_total(counts, name, "share_pct")


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """``value`` as a percentage of its total over all rows."""
    total = df.agg(wide_sum(value)).scalar()
    return df.withColumn(name, pct(F.col(value), total))


def argmax(df: DataFrame, key: str, measure: Column) -> DataFrame:
    """The group with the largest measure (smallest key wins ties)."""
    agg = df.groupBy(key).agg(measure.alias("measure"))
    return agg.orderBy(F.desc("measure"), F.asc(key)).limit(1)


def distinct_list(df: DataFrame, keys: Sequence[str], column: str, name: str, sep: str = ", ") -> DataFrame:
    """Sorted list of the distinct values per group; duplicates go before anything is collected.

    The list itself is the result: a group's cell is as long as it has distinct values. Use it
    for catalogue columns (types, statuses), not for identifiers.
    """
    pairs = df.select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(column)), sep).alias(name))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum falls into the last bin."""
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    position = F.floor(F.try_divide((F.col(value) - lo) * F.lit(float(bins)), hi - lo))
    bucket = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("bigint")
    return df.where(F.col(value).isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("row_count"))


def boxplot(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, 1.5 IQR fences and the number of points beyond them per group."""
    q = scale.percentiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumns({"lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr})
    stats = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    if keys:
        marked = scale.same_key_join(df, fences, keys)
    else:
        one = fences.select(F.struct(*stats).alias("s")).scalar()
        marked = df.select(value).withColumns({c: one.getField(c) for c in stats})
    beyond = (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))
    return marked.groupBy(*keys, *stats).agg(F.count(F.lit(1)).alias("row_count"), F.count(F.when(beyond, 1)).alias("outliers"))


def coefficient_of_variation(df: DataFrame, keys: Sequence[str], value: str, min_rows: int) -> DataFrame:
    """Deviation as a percentage of the mean for groups of at least ``min_rows`` rows."""
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), davg(value).alias("mean"), F.stddev_samp(value).alias("_sd")
    )
    return agg.where(F.col("row_count") >= min_rows).select(
        *keys, "row_count", "mean", F.round(pct("_sd", "mean"), 4).alias("cv_pct")
    )


def grid(df: DataFrame, x: Column, y: Column, measures: dict[str, Column]) -> DataFrame:
    """Aggregates per 2-D cell."""
    return df.groupBy(x.alias("x_cell"), y.alias("y_cell")).agg(*[c.alias(n) for n, c in measures.items()])


_SHEET = {
    "COUNT": lambda c: F.count(F.lit(1)),
    "SUM": dsum,
    "AVG": davg,
    "MIN": F.min,
    "MAX": F.max,
}


def sheet_aggregate(df: DataFrame, by: str, func: str, value: str | None = None, limit: int = 100) -> DataFrame:
    """One aggregate per value of one column, largest first, at most ``limit`` groups shown."""
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must be between 1 and 10000")
    measure = _SHEET[func.upper()](value)
    return df.groupBy(by).agg(measure.alias("result")).orderBy(F.desc("result"), F.asc(by)).limit(limit)


def back_propagate(dim: DataFrame, facts: DataFrame, key: str, counts: dict[str, Column]) -> DataFrame:
    """Fact counts written back onto the dimension, 0 for members without facts."""
    agg = facts.groupBy(key).agg(*[c.alias(n) for n, c in counts.items()])
    out = dim.join(agg, key, "left")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0).cast(agg.schema[n].dataType)) for n in counts})


def mean_of(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(ratio(F.sum(value), F.count(value)).alias(name))
