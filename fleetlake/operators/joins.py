"""Joins beyond a plain equi-join: spines, as-of, point-in-time, reconciliation, route lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.constants import ROAD_FACTOR
from fleetlake.functions.scalar import haversine_km
from fleetlake.operators import scale
from fleetlake.session import materialise


def left_with_zero(dim: DataFrame, facts: DataFrame, key: str, aggs: Mapping[str, Column], fills: Mapping[str, object]) -> DataFrame:
    """Every dimension row with its fact aggregates; facts are aggregated before the join."""
    agg = facts.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    joined = dim.join(agg, key, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in fills.items()})


def preaggregated(dim: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """Dimension with several aggregates, each already one row per key (no fan-out)."""
    for part in parts:
        dim = dim.join(part, key, "left")
    return dim


def reconcile(left: DataFrame, right: DataFrame, key: str, labels: Sequence[str] = ("Matched", "Orphan", "Never used")) -> DataFrame:
    """Full outer comparison of two key sets."""
    a = left.select(F.col(key).alias("left_key")).distinct()
    b = right.select(F.col(key).alias("right_key")).distinct()
    both, orphan, unused = labels
    return a.join(b, F.col("left_key") == F.col("right_key"), "full").withColumn(
        "status",
        F.when(F.col("left_key").isNull(), orphan).when(F.col("right_key").isNull(), unused).otherwise(both),
    )


def balance(a: DataFrame, b: DataFrame, key: str, fills: Mapping[str, object]) -> DataFrame:
    """Two per-key aggregates side by side; a side without the key counts as its fill value."""
    joined = a.join(b, key, "full")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in fills.items()})


def month_spine(df: DataFrame, ts: str, name: str = "month") -> DataFrame:
    """Every month from the first to the last one in ``df`` (one aggregate row, exploded)."""
    lo, hi = F.trunc(F.min(ts), "month"), F.trunc(F.max(ts), "month")
    return df.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL '1' MONTH"))).alias(name)
    )


def day_spine(df: DataFrame, ts: str, name: str = "day") -> DataFrame:
    """Every day from the first to the last one in ``df``."""
    return df.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL '1' DAY"))).alias(name)
    )


#: Rows of the right and of the left side that one block of a product holds.
RIGHT_BLOCK, LEFT_BLOCK = 1_000, 100_000


def product(left: DataFrame, right: DataFrame, right_block: int = RIGHT_BLOCK, left_block: int = LEFT_BLOCK) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, for results that are such a grid.

    Both sides are dealt into blocks of limited size, blocks meet by an equality join on their two numbers, and
    each left row explodes the right rows of its block: no cell and no task holds a whole side. The sides
    must not share column names; both are counted first.
    """
    columns = right.columns

    def blocks(df: DataFrame, size: int) -> Column:
        n = df.agg(F.count(F.lit(1)).alias("n")).select(F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("long").alias("n"))
        return n.scalar()

    n_left, n_right = blocks(left, left_block), blocks(right, right_block)
    dealt = right.withColumn("_b", F.pmod(F.monotonically_increasing_id(), n_right))
    packed = dealt.groupBy("_b").agg(F.collect_list(F.struct(*columns)).alias("_v"))
    packed = packed.withColumn("_a", F.explode(F.sequence(F.lit(0).cast("long"), n_left - 1)))
    own = left.withColumn("_a", F.pmod(F.monotonically_increasing_id(), n_left)).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), n_right - 1)))
    return own.join(packed, ["_a", "_b"]).select(*left.columns, F.inline("_v")).toDF(*left.columns, *columns)


def matrix(rows: DataFrame, cells: DataFrame, row_key: str, col_key: str, values: DataFrame, name: str = "cells") -> DataFrame:
    """Count per (row, value) with zeros kept; ``values`` has the column values, repeats allowed.

    The grid of all rows and values is the result, so it is as large as both together say. Nothing passes through
    the driver, and neither side is gathered in one place (see ``product``).
    """
    listed = values.select(col_key).where(F.col(col_key).isNotNull()).distinct()
    grid = product(rows, listed)
    counts = cells.groupBy(row_key, col_key).agg(F.count(F.lit(1)).alias(name))
    return grid.join(counts, [row_key, col_key], "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def first_values(df: DataFrame, column: str, count: int) -> list:
    """The first ``count`` distinct values of a column in ascending order, for pivot columns."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(count).collect()
    return [v[0] for v in found]


def price_steps(timeline: Sequence[tuple[str, float]], on: Column, default: float) -> Column:
    """Value of the last step on or before ``on`` from a short literal timeline."""
    out = F.when(F.lit(False), F.lit(default))
    for start, value in sorted(timeline, reverse=True):
        out = out.when(on >= F.lit(start).cast("date"), F.lit(value))
    return out.otherwise(F.lit(default))


def _carried(facts: DataFrame, entries: DataFrame, by: Sequence[str], on: str) -> DataFrame:
    """``facts`` with ``_carried``: the ``_value`` of the last entry (``by``, ``_at``, ``_value``) of its key on or before the day ``on``.

    Facts and entries are put in one order per key, entries before the facts of their day, and the
    last entry is carried forward: one shuffle, no range join. Where a key is too large for one
    task, entries are numbered along the split order instead, and a fact meets its entry by
    number. Of entries with one key and day the same one is always taken.
    """
    known = F.col("_at").isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    left = facts.withColumn("_at", F.to_date(F.col(on)))
    both = left.withColumn("_fact", F.lit(True)).unionByName(entries.where(known).withColumn("_fact", F.lit(False)), allowMissingColumns=True)
    columns = F.xxhash64(*[c for c in both.columns if c not in ("_at", "_fact")])
    both = both.withColumn("_tie", F.when(~F.col("_fact"), columns))
    order = ["_at", "_fact", "_tie"]
    split = scale.Split(both, by, order)
    if split.small:
        w = Window.partitionBy(*by).orderBy(*scale.order_columns(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = F.last(F.when(~F.col("_fact"), F.struct("_value")), ignorenulls=True).over(w)["_value"]
        found = split.of(both).withColumn("_carried", carried)
    else:
        entry = F.when(F.col("_fact"), 0).otherwise(1).cast("bigint")
        # facts get a tie too: it splits a day with very many of them
        numbered = scale.running(split.of(both).withColumn("_tie", F.coalesce("_tie", columns)), by, order, {"_nth": entry}, split=split)
        steps = numbered.where(~F.col("_fact")).select(*by, "_nth", F.col("_value").alias("_carried"))
        found = numbered.join(steps, [*by, "_nth"], "left")
    return found.where("_fact").select(*facts.columns, F.when(known, F.col("_carried")).alias("_carried"))


#: Different keys and days up to which every task of the facts gets them all.
BROADCAST_DAYS = 50_000


def asof_join(
    facts: DataFrame, timeline: DataFrame, by: Sequence[str], on: str, since: str, value: str, default=None
) -> DataFrame:
    """Each fact with the value in force at ``on``: the last entry with ``since <= on``, by day.

    Entries are carried forward over the different days of the facts of each key (see ``_carried``), also over keys too
    large for one task; the facts then meet their day by an equality join, so their other columns are not
    ordered or stored. Facts with a NULL key or day get no value.
    """
    entries = timeline.select(*by, F.to_date(since).alias("_at"), F.col(value).alias("_value"))
    dated = facts.withColumn("_day", F.to_date(F.col(on)))
    days = materialise(dated.select(*by, "_day").na.drop().distinct(), "fact-days")
    found = _carried(days, entries, by, "_day")
    if days.count() <= BROADCAST_DAYS:
        found = F.broadcast(found)
    out = dated.join(found, [*by, "_day"], "left").select(*facts.columns, F.col("_carried").alias(value))
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def point_in_time(facts: DataFrame, dim: DataFrame, key: str, on: str, how: str = "inner") -> DataFrame:
    """Facts with the dimension version valid on their day (``valid_from <= on <= valid_to``).

    The versions of a key must not overlap (``overlapping_versions`` finds those that do); then the one
    that began last is the only candidate, is carried forward, and its end is compared once per fact:
    a key with very many facts or versions is split like any other ordered work. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    data = [c for c in dim.columns if c != key]
    entries = dim.select(key, F.to_date("valid_from").alias("_at"), F.struct(*data).alias("_value"))
    found = _carried(facts, entries, [key], on)
    valid = F.coalesce(F.to_date(on) <= F.to_date(F.col("_carried.valid_to")), F.lit(False))
    columns = [F.when(valid, F.col("_carried").getField(c)).alias(c) for c in data]
    out = found.where(valid) if how == "inner" else found
    return out.select(*facts.columns, *columns)


def overlapping_versions(dim: DataFrame, key: str) -> DataFrame:
    """Versions that begin before an earlier one of their key has ended, with the day that one ends."""
    ends = scale.bounded(dim, [key], ["valid_from", "valid_to"], {"previous_end": lambda w: F.lag("valid_to").over(w)}, before=1, after=0)
    return ends.where(F.col("previous_end") >= F.col("valid_from"))


def same_group_conflicts(df: DataFrame, keys: Sequence[str], ident: str) -> DataFrame:
    """Rows that share their group with others: number of conflicts and the next row in conflict.

    Following ``next_id`` walks through a whole group; all pairs are never written out.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    shared = df.join(sizes, list(keys))
    linked = scale.bounded(shared, keys, [ident], {"next_id": lambda w: F.lead(ident).over(w)}, before=0, after=1)
    return linked.withColumn("conflicts", F.col("_n") - 1).drop("_n")


def route_distance(
    pairs: DataFrame, known: DataFrame, a: str, b: str, lat1: str, lon1: str, lat2: str, lon2: str
) -> DataFrame:
    """Known distance of an unordered pair (``place_a, place_b, km``), else great circle times the road factor."""
    left = pairs.withColumns({"_lo": F.least(a, b), "_hi": F.greatest(a, b)})
    right = known.select(F.least("place_a", "place_b").alias("_lo"), F.greatest("place_a", "place_b").alias("_hi"), "km")
    estimate = haversine_km(F.col(lat1), F.col(lon1), F.col(lat2), F.col(lon2)) * ROAD_FACTOR
    return (
        left.join(right.dropDuplicates(["_lo", "_hi"]), ["_lo", "_hi"], "left")
        .withColumn("distance_km", F.coalesce(F.col("km").cast("double"), F.round(estimate, 1)))
        .drop("_lo", "_hi", "km")
    )
