"""Filters that take their columns and values as parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"

PERIODS = ("hourly", "daily", "weekly", "monthly", "quarterly", "bi-annual", "annual")


def dim_filter(df: DataFrame, choices: Mapping[str, object], year_of: str | None = None) -> DataFrame:
    """Equality filters; the value ``All`` (or None) leaves a column alone.

    The key ``year`` filters the year of ``year_of`` as a date range, which the scan can use.
    """
    for name, value in choices.items():
        if value is None or value == ALL:
            continue
        if name == "year" and year_of:
            df = period_slice(df, year_of, f"{int(value)}-01-01 00:00:00", f"{int(value)}-12-31 23:59:59.999999")
        else:
            df = df.where(F.col(name) == F.lit(value))
    return df


def period_slice(df: DataFrame, ts: str, start: str | datetime, end: str | datetime) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    return df.where(F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def period_bounds(ts: str | Column, period: str) -> tuple[Column, Column]:
    """First and last second of the period around ``ts`` (weeks start on Monday)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    second = F.expr("INTERVAL '1' SECOND")
    if period == "hourly":
        start = F.date_trunc("hour", c)
        return start, start + F.expr("INTERVAL '1' HOUR") - second
    if period == "daily":
        start = F.date_trunc("day", c)
        return start, start + F.expr("INTERVAL '1' DAY") - second
    if period == "weekly":
        start = F.date_trunc("week", c)
        return start, start + F.expr("INTERVAL '7' DAY") - second
    months = {"monthly": ("month", 1), "quarterly": ("quarter", 3), "annual": ("year", 12)}
    if period in months:
        unit, n = months[period]
        start = F.date_trunc(unit, c)
        return start, start + F.expr(f"INTERVAL '{n}' MONTH") - second
    if period == "bi-annual":
        first = F.date_trunc("year", c)
        start = F.when(F.month(c) <= 6, first).otherwise(first + F.expr("INTERVAL '6' MONTH"))
        return start, start + F.expr("INTERVAL '6' MONTH") - second
    raise ValueError(f"unknown period {period!r}")


def semi_filter(facts: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Facts whose key is among the selected rows."""
    return facts.join(selected.select(key), key, "left_semi")


def sheet_filter(df: DataFrame, column: str, text: str) -> DataFrame:
    """``column == text`` with case-insensitive column lookup; ``text`` is read as the column's type."""
    names = {c.lower(): c for c in df.columns}
    if column.lower() not in names:
        raise ValueError(f"no column {column!r}")
    name = names[column.lower()]
    return df.where(F.col(name) == F.lit(text).cast(df.schema[name].dataType))


def blank(c: str) -> Column:
    """NULL or empty after trimming."""
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def any_of(c: str, values: Sequence) -> Column:
    return F.col(c).isin(*values)
