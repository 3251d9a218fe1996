"""Set operations, de-duplication, insert-new and upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.operators.scale import order_columns


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order`` (give a full tie-break).

    Spark keeps one row per key and task before the shuffle, so a key with very many
    copies never travels whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str = "rn") -> DataFrame:
    """First ``n`` rows per key with their position."""
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= n)


def insert_new(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the delta rows whose key it does not hold."""
    fresh = delta.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows by key, insert the rest. ``delta`` must hold each key once."""
    kept = target.join(delta.select(*keys), list(keys), "left_anti")
    return kept.unionByName(delta)


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: the same rows on every run."""
    stamp = F.md5(F.concat_ws(":", *keys, F.lit(str(seed))))
    return df.withColumn("_h", stamp).orderBy("_h", *keys).limit(n).drop("_h")
