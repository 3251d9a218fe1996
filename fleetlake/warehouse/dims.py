"""Dimensions: calendar, slowly changing, conformed; key lookups for facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.operators import joins, scale
from fleetlake.operators.sets import union_all

OPEN_END = "9999-12-31"
UNKNOWN = -1


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def dim_date(df: DataFrame, ts: str, holidays: Sequence[str] = ()) -> DataFrame:
    """One row per day over the span of ``ts``; holidays are a parameter list of dates or MM-dd."""
    d = F.col("date")
    holiday = F.date_format(d, "yyyy-MM-dd").isin(*holidays) | F.date_format(d, "MM-dd").isin(*holidays) if holidays else F.lit(False)
    return joins.day_spine(df, ts, "date").select(
        date_key(d).alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("quarter_label"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"), holiday.alias("is_holiday"),
    )


def _row_hash(tracked: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)


def scd2_initial(source: DataFrame, valid_from: str) -> DataFrame:
    """First load: every row is current from ``valid_from``."""
    return source.withColumns(
        {"valid_from": F.lit(valid_from).cast("date"), "valid_to": F.lit(OPEN_END).cast("date"), "is_current": F.lit(True)}
    )


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], on: str) -> DataFrame:
    """Dimension after a batch of source rows (one per key) valid from day ``on``.

    A changed key closes its current version at ``on`` - 1 and opens a new one; a new key
    opens one; unchanged and vanished keys stay. Applying the same batch again changes
    nothing.
    """
    day = F.lit(on).cast("date")
    data = [c for c in dim.columns if c not in ("valid_from", "valid_to", "is_current")]
    fresh = incoming.select(*data).withColumn("_new", _row_hash(tracked))
    current = dim.where(F.col("is_current")).withColumn("_old", _row_hash(tracked))
    changes = fresh.join(current.select(key, "_old"), key, "left").where(F.col("_old").isNull() | (F.col("_old") != F.col("_new")))
    opened = changes.select(*data, day.alias("valid_from"), F.lit(OPEN_END).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    closing = changes.where(F.col("_old").isNotNull()).select(key, F.lit(True).alias("_close"))
    marked = dim.join(closing, key, "left")
    close = F.col("is_current") & F.col("_close")
    # a second change on the same day replaces the version opened that day
    kept = marked.where(~F.coalesce(close & (F.col("valid_from") == day), F.lit(False))).select(
        *data,
        "valid_from",
        F.when(close, F.date_sub(day, 1)).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & F.col("_close").isNull()).alias("is_current"),
    )
    return union_all(kept, opened.select(*kept.columns))


def with_surrogate_keys(df: DataFrame, natural: str, name: str, unknown: dict[str, object]) -> DataFrame:
    """Integer keys 1..n in natural-key order plus the unknown member -1."""
    keyed = scale.row_number(df, [], [natural], name)
    filler = df.sparkSession.createDataFrame([()], "struct<>").select(
        *[F.lit(unknown.get(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns], F.lit(UNKNOWN).cast("bigint").alias(name)
    )
    return union_all(keyed.select(*df.columns, name), filler)


def lookup(fact: DataFrame, dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Surrogate key of the natural key, -1 where the dimension has none."""
    table = dim.where(F.col(key) != UNKNOWN).select(natural, key)
    return fact.join(table, natural, "left").withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN).cast("bigint")))


def lookup_at(fact: DataFrame, dim: DataFrame, natural: str, key: str, on: str) -> DataFrame:
    """Surrogate key of the version valid on the fact's day ``on``, -1 where none is.

    ``dim`` has one surrogate key per version, with valid_from and valid_to.
    """
    versions = dim.where(F.col(key) != UNKNOWN).select(natural, key, "valid_from", "valid_to")
    found = joins.point_in_time(fact, versions, natural, on, how="left").drop("valid_from", "valid_to")
    return found.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN).cast("bigint")))
