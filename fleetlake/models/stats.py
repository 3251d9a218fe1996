"""Statistics without a trained model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import rows
from fleetlake.operators import scale
from fleetlake.session import materialise


def zscore_anomalies(df: DataFrame, key: str, value: str, threshold: float = 2.0) -> DataFrame:
    """Rows further than ``threshold`` deviations from their group's mean; an undefined deviation counts as 1."""
    stats = df.groupBy(key).agg(F.avg(value).alias("group_mean"), F.coalesce(F.stddev_samp(value), F.lit(1.0)).alias("group_std"))
    z = F.try_divide(F.col(value) - F.col("group_mean"), F.col("group_std"))
    return df.join(stats, key).withColumn("z_score", z).where(F.abs("z_score") > threshold)


def quantile_scores(df: DataFrame, columns: dict[str, tuple[str, bool]], bins: int = 5) -> DataFrame:
    """Score 1..bins by quantile edges (right-closed bins); ``True`` means a low value is best.

    Equal edges collapse, as there is then no bin between them. Missing values get NULL.
    """
    df = materialise(df, "scored")  # read by every score
    out = df
    probs = [i / bins for i in range(1, bins)]
    for name, (column, low_is_best) in columns.items():
        edges = scale.percentiles(df, [], column, {f"e{i}": p for i, p in enumerate(probs)})
        cells = edges.select(F.array(*[F.col(f"e{i}").cast("double") for i in range(bins - 1)]).alias("a")).scalar()
        above = F.aggregate("_e", F.lit(0), lambda n, e: n + F.when(F.col(column) > e, 1).otherwise(0))
        score = F.lit(bins) - above if low_is_best else above + 1
        scored = F.when(F.col(column).isNotNull(), score).cast("bigint")
        out = out.withColumn("_e", cells).withColumn(name, scored).drop("_e")
    return out


def segment(score: Column | str) -> Column:
    """Segment of a summed score in right-closed bins 0, 5, 8, 11, 15."""
    return fn.cut(score, [0, 5, 8, 11, 15], ["At Risk", "Regular", "Loyal", "Champion"])


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], keys: Sequence[str] = ()) -> DataFrame:
    """Correlation, slope and intercept of y on x per pair, from one pass."""
    aggs = [rows().alias("n")]
    for x, y in pairs:
        aggs += [
            F.corr(x, y).alias(f"corr_{x}_{y}"), F.regr_slope(y, x).alias(f"slope_{x}_{y}"), F.regr_intercept(y, x).alias(f"intercept_{x}_{y}")
        ]
    return df.groupBy(*keys).agg(*aggs)
