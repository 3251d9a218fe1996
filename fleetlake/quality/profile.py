"""Column profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.scalar import count_if, pct, rows
from fleetlake.operators import aggregates


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """``value, n`` for the non-NULL values of one column, the value as text."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    return counts.select(F.col(column).cast("string").alias("value"), "n")


def counted_values(df: DataFrame) -> DataFrame:
    """``place, value, n``: how often each value occurs in each column (``place`` is its index), the value as text.

    One scan and one shuffle for all columns: every row yields one (column, value) pair per column, and tasks
    count before they shuffle, so a frequent value travels once per task.
    """
    cells = []
    for i, f in enumerate(df.schema.fields):
        # one zero, as grouping sees it
        v = F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f"`{f.name}`")
        cells.append(F.struct(F.lit(i).alias("place"), v.cast("string").alias("value")))
    return df.select(F.inline(F.array(*cells))).groupBy("place", "value").agg(rows().alias("n"))


def profile_columns(df: DataFrame, top: int = 3, approximate: bool = False) -> DataFrame:
    """Per column: nulls, distinct values, numeric minimum/maximum/mean, most frequent values, grade.

    Everything comes from the counted values of ``counted_values``: nulls, extremes and sums are sums over
    values and their numbers. ``approximate`` keeps sketches instead of counts and leaves out the most frequent values.
    """
    null_pct = F.coalesce(pct("nulls", "row_count"), F.lit(0.0))
    grade = F.when(null_pct <= 1, "Good").when(null_pct <= 5, "Acceptable").otherwise("Bad")
    if approximate:
        return _sketched(df).withColumns({"null_pct": null_pct, "health": grade})
    kinds = [f.dataType for f in df.schema.fields]
    numeric = [i for i, k in enumerate(kinds) if isinstance(k, T.NumericType)]
    single = [i for i in numeric if isinstance(kinds[i], T.FloatType)]
    counts = counted_values(df)
    # a float's text names the float; its double differs from the double of that text
    num = F.when(F.col("place").isin(single), F.col("value").try_cast("float").cast("double")).otherwise(F.col("value").try_cast("double"))
    num = F.when(F.col("place").isin(numeric), num)
    n, filled = F.col("n"), F.col("value").isNotNull()
    total = F.sum(num.cast("decimal(18,4)") * n).cast("double")
    stats = counts.groupBy("place").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(~filled, n)), F.lit(0)).alias("nulls"), F.min(num).alias("lowest"), F.max(num).alias("highest"),
        F.try_divide(total, F.sum(F.when(filled, n))).alias("mean"), F.count("value").alias("distinct_values"),
    )
    # NULL goes last instead of being filtered, so that both aggregates read the same shuffled counts
    order = Window.partitionBy("place").orderBy(F.col("value").isNull(), F.desc("n"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    label = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(filled, F.struct("rank", "value", "n")))), lambda x: F.concat(x["value"], F.lit(" ("), x["n"], F.lit(")"))), ", ")
    named = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "place int, column_name string")
    out = named.join(stats, "place", "left").join(best.groupBy("place").agg(F.nullif(label, F.lit("")).alias("top_values")), "place", "left")
    none = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("row_count", "nulls", "distinct_values")}
    out = out.withColumns(none).select("column_name", "row_count", "nulls", "lowest", "highest", "mean", "top_values", "distinct_values")
    return out.withColumns({"null_pct": null_pct, "health": grade})


def _sketched(df: DataFrame) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = [rows().alias("_n")]
    for c in df.columns:
        num = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        stats += [
            count_if(F.col(c).isNull()).alias(f"{c}.nulls"), F.min(num).alias(f"{c}.lo"), F.max(num).alias(f"{c}.hi"),
            F.sum(num.cast("decimal(18,4)")).cast("double").alias(f"{c}.sum"), F.approx_count_distinct(c).alias(f"{c}.distinct"),
        ]
    cells = []
    for c in df.columns:
        filled = F.col("_n") - F.col(f"`{c}.nulls`")
        cells.append(F.struct(
            F.lit(c).alias("column_name"), F.col("_n").alias("row_count"), F.col(f"`{c}.nulls`").alias("nulls"), F.col(f"`{c}.lo`").alias("lowest"), F.col(f"`{c}.hi`").alias("highest"),
            F.try_divide(F.col(f"`{c}.sum`"), filled).alias("mean"), F.col(f"`{c}.distinct`").alias("distinct_values"),
        ))
    return df.agg(*stats).select(F.inline(F.array(*cells)))


def outliers(df: DataFrame, value: str) -> DataFrame:
    """IQR fences with the number and share of values beyond them (one row)."""
    box = aggregates.boxplot(df, [], value)
    return box.withColumn("outlier_pct", pct("outliers", "row_count"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, quartiles, IQR, bias-corrected skewness and excess kurtosis (one row)."""
    from fleetlake.operators import scale

    n, v = F.col("n").cast("double"), F.col(value)
    m = df.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.skewness(v).alias("_g1"), F.kurtosis(v).alias("_g2")
    )
    q = scale.percentiles(df, [], value, {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95})
    one = q.select(F.struct("p25", "median", "p75", "p95").alias("s")).scalar()
    m = m.withColumns({c: one.getField(c) for c in ("p25", "median", "p75", "p95")})
    skew = F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6)
    return m.withColumns({"iqr": F.col("p75") - F.col("p25"), "skew": F.when(n > 2, skew), "kurt": F.when(n > 3, kurt)}).drop("_g1", "_g2")
