"""Registry of queries bound to the sample tables, each with its checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.catalog.adapters import VIEW_SQL, Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with the SQL that must give the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def _needed(text: str, seen: list[str]) -> list[str]:
    for view, body in VIEW_SQL.items():
        if view not in seen and re.search(rf"\b{view}\b", text):
            _needed(body, seen)
            if view not in seen:
                seen.append(view)
    return seen


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the adapter views it names."""
    sql = sql.strip()
    views = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in _needed(sql, []))
    if not views:
        return sql
    start = re.match(r"WITH(\s+RECURSIVE)?\s", sql, re.I)
    if start:
        return f"WITH{start.group(1) or ''} {views},\n{sql[start.end():]}"
    return f"WITH {views}\n{sql}"


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so both engines print them alike."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


_OPEN: WeakKeyDictionary[SparkSession, dict[str, Tables]] = WeakKeyDictionary()


def open_tables(spark: SparkSession, root: str, refresh: bool = False) -> Tables:
    """The tables of a folder, opened once per session: plans are shared, no data is kept.

    ``refresh`` opens them again, for a folder whose files have changed since. An entry goes
    with its session.
    """
    known = _OPEN.setdefault(spark, {})
    if refresh or root not in known:
        known[root] = Tables(spark, root)
    return known[root]


def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(QUERIES[name](open_tables(spark, sf_dir)))

    run.__name__ = name
    return run


# --- shorthands for the checking SQL ---


def S(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def A(c: str) -> str:
    return f"(CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT({c}), 0))"


def SI(pred: str, c: str) -> str:
    return f"COALESCE(CAST(SUM(CASE WHEN {pred} THEN CAST({c} AS DECIMAL(18,4)) END) AS DOUBLE), 0.0::DOUBLE)"


def CI(pred: str) -> str:
    return f"COUNT(CASE WHEN {pred} THEN 1 END)"


def D(c: str) -> str:
    return f"CAST(CAST({c} AS DATE) AS VARCHAR)"


def TS(c: str) -> str:
    return f"CAST(CAST({c} AS TIMESTAMP) AS VARCHAR)"


def R(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def P(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({b} AS DOUBLE), 0))"


def M(c: str) -> str:
    return f"CAST(DATE_TRUNC('month', {c}) AS DATE)"
