"""KPI, alert and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.constants import KPI_THRESHOLDS
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import dsum, rows


def unpivot_row(row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame of numbers as (metric, value) rows."""
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return doubles.unpivot([], doubles.columns, name, value)


def metric_layer(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Named metrics computed in one pass, in long form."""
    return unpivot_row(df.agg(*[c.cast("double").alias(n) for n, c in metrics.items()]))


def kpi_flags(metrics: DataFrame, thresholds: Sequence[tuple[str, float, float, bool]] = KPI_THRESHOLDS) -> DataFrame:
    """good / warn / bad per metric from a small thresholds table."""
    limits = metrics.sparkSession.createDataFrame(
        list(thresholds), "metric string, good double, warn double, higher_is_better boolean"
    )
    v, up = F.col("value"), F.col("higher_is_better")
    good = F.when(up, v >= F.col("good")).otherwise(v < F.col("good"))
    warn = F.when(up, v >= F.col("warn")).otherwise(v < F.col("warn"))
    level = F.when(good, "good").when(warn, "warn").otherwise("bad")
    return metrics.join(limits, "metric").select("metric", "value", level.alias("level"))


PERIOD_FORMATS = {"hour": "yyyy-MM-dd HH:00", "day": "yyyy-MM-dd", "weekday": "EEEE", "month": "yyyy-MM"}


def trend(df: DataFrame, ts: str, granularity: str, measures: Mapping[str, Column]) -> DataFrame:
    """Measures per period label."""
    label = F.date_format(ts, PERIOD_FORMATS[granularity]).alias("period")
    return df.groupBy(label).agg(*[c.alias(n) for n, c in measures.items()])


def expiry_alerts(df: DataFrame, key: str, dates: Mapping[str, str], as_of: str, soon_days: int = 30) -> DataFrame:
    """One row per expired or soon-expiring document: key, document, expiry and severity."""
    today = F.lit(as_of).cast("date")
    docs = F.array(*[F.struct(F.lit(name).alias("document"), F.col(c).alias("expiry")) for name, c in dates.items()])
    long = df.select(key, F.explode(docs).alias("d")).select(key, "d.document", "d.expiry")
    severity = F.when(F.col("expiry") < today, "expired").when(F.col("expiry") < F.date_add(today, soon_days), "expiring")
    return long.withColumn("severity", severity).where(F.col("severity").isNotNull())


def billing_measures() -> dict[str, Column]:
    return {
        "billed": dsum("total_amount"),
        "collected": dsum("paid_amount"),
        "outstanding": dsum("outstanding"),
        "invoices": rows(),
    }


def driver_risk_index(rates: Mapping[str, float], digits: int = 1) -> Column:
    """Weighted behaviour rates times 100, clipped to 0..100."""
    total = None
    for name, weight in rates.items():
        part = F.col(name) * F.lit(float(weight))
        total = part if total is None else total + part
    return F.round(fn.clip(total * 100, 0.0, 100.0), digits)


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest value of ``column``."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())
