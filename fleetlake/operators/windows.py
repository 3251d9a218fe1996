"""Ordered analytics: sessions, cumulative shares, growth, rolling means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.scalar import days_between, pct, wide_money, wide_sum
from fleetlake.operators import scale
from fleetlake.session import materialise


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_days: int | None = None, gap_seconds: float | None = None) -> DataFrame:
    """Number the sessions of each key; a gap longer than the limit starts a new one."""
    order = [ts, tie]
    split = scale.Split(df, keys, order)
    prev = scale.bounded(df, keys, order, {"_prev": lambda w: F.lag(ts).over(w)}, split=split)
    if gap_days is not None:
        far = days_between("_prev", ts) > gap_days
    else:
        micros = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_prev"))
        far = micros > int(gap_seconds * 1_000_000)
    starts = prev.withColumn("_start", F.when(F.col("_prev").isNull() | far, 1).otherwise(0).cast("bigint"))
    if not split.small:
        starts = materialise(starts, "session-starts")  # read twice below
    return scale.running(starts, keys, order, {"session_id": F.col("_start")}, split=split).drop("_prev", "_start")


def pareto(df: DataFrame, value: str, tie: str, cut: float = 80.0) -> DataFrame:
    """Cumulative share of the total from the largest value down, tagged at ``cut`` percent.

    ``df`` is an aggregate that three steps read, so it is written once.
    """
    df = materialise(df, "pareto")
    total = df.agg(wide_sum(value)).scalar()
    run = scale.running(df, [], [f"-{value}", tie], {"_run": wide_money(value)})
    return (
        run.withColumn("running_total", F.col("_run").cast("double"))
        .withColumn("cumulative_pct", pct(F.col("running_total"), total))
        .withColumn("pareto_group", F.when(F.col("cumulative_pct") <= cut, f"Top {cut:.0f}%").otherwise(f"Tail {100 - cut:.0f}%"))
        .drop("_run")
    )


def growth(df: DataFrame, keys: Sequence[str], order: str, value: str, scale_rows: bool = False) -> DataFrame:
    """Previous value, change and change in percent.

    For one row per period and key; ``scale_rows`` uses the split-safe form for raw rows.
    """
    if scale_rows:
        out = scale.bounded(df, keys, [order], {"prev": lambda w: F.lag(value).over(w)})
    else:
        out = df.withColumn("prev", F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
    change = F.col(value) - F.col("prev")
    return out.withColumns({"change": change, "change_pct": pct(change, "prev")})


def rolling(value: Column, order: str, rows: int, keys: Sequence[str] = (), fn=F.avg, strict: bool = False, ahead: int = 0) -> Column:
    """Rolling function over the last ``rows`` rows; ``strict`` gives NULL until that many exist."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), ahead)
    out = fn(value).over(w)
    return F.when(F.count(value).over(w) == rows + ahead, out) if strict else out
