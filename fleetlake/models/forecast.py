"""Monthly revenue forecast: additive damped Holt-Winters, one small series per group."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.scalar import dsum, month_start, pct

BAND = 0.15
MIN_MONTHS = 12
_GRID = (0.1, 0.3, 0.6, 0.9)
_DAMPING = (0.8, 0.9, 0.98, 0.995)


def smooth(y: np.ndarray, period: int, alpha: float, beta: float, gamma: float, phi: float, horizon: int) -> tuple[float, np.ndarray]:
    """Squared one-step error and forecast of one parameter choice."""
    mean, trend = float(y[:period].mean()), float((y[period : 2 * period].mean() - y[:period].mean()) / period)
    line = mean + trend * (np.arange(period) - (period - 1) / 2)
    season, level = list(y[:period] - line), float(line[-1])
    error = 0.0
    for i in range(period, len(y)):
        s, base = season[i % period], level + phi * trend
        error += (y[i] - base - s) ** 2
        new = alpha * (y[i] - s) + (1 - alpha) * base
        trend = beta * (new - level) + (1 - beta) * phi * trend
        season[i % period] = gamma * (y[i] - new) + (1 - gamma) * s
        level = new
    steps = np.cumsum(phi ** np.arange(1, horizon + 1))
    return error, np.array([level + steps[h] * trend + season[(len(y) + h) % period] for h in range(horizon)])


def best_forecast(y: np.ndarray, horizon: int) -> np.ndarray:
    """Forecast of the parameters with the smallest one-step error; short series repeat their last value."""
    if len(y) < MIN_MONTHS:
        y = np.concatenate([y, np.full(MIN_MONTHS - len(y), y[-1])])
    period = min(12, len(y) // 2)
    fits = (smooth(y, period, a, b, g, p, horizon) for a, b, g, p in itertools.product(_GRID, _GRID, _GRID, _DAMPING))
    return min(fits, key=lambda fit: fit[0])[1]


def revenue_forecast(df: DataFrame, key: str, ts: str, amount: str, periods: int = 6) -> DataFrame:
    """Next months per key with a band of 15 %.

    Rows are summed to one value per key and month first, so a group handed to a task
    holds at most a few hundred rows however large the key is.
    """
    monthly = df.groupBy(key, month_start(ts).alias("month")).agg(dsum(amount).alias("total"))
    kind = df.schema[key].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month")
        months = pd.PeriodIndex(pd.to_datetime(pdf["month"]), freq="M")
        series = pd.Series(pdf["total"].to_numpy(), index=months).reindex(pd.period_range(months[0], months[-1], freq="M"), fill_value=0.0)
        values = best_forecast(series.to_numpy(dtype=float), periods)
        ahead = [(series.index[-1] + h).to_timestamp().date() for h in range(1, periods + 1)]
        return pd.DataFrame(
            {key: pdf[key].iloc[0], "month": ahead, "forecast": values, "lower": values * (1 - BAND), "upper": values * (1 + BAND)}
        )

    return monthly.groupBy(key).applyInPandas(fit, f"{key} {kind}, month date, forecast double, lower double, upper double")


def outlook(series: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Per key: mean forecast, growth of the first forecast month against ``last_actual`` in percent, peak month and its value."""
    ahead = series.groupBy(key).agg(
        F.min_by("forecast", "month").alias("next_forecast"), F.avg("forecast").alias("mean_forecast"), F.max_by("month", "forecast").alias("peak_month"), F.max("forecast").alias("peak")
    )
    joined = ahead.join(actual, key)
    return joined.withColumn("growth_pct", pct(F.col("next_forecast") - F.col("last_actual"), "last_actual"))
