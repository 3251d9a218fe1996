"""Warehouse jobs: staging, state, incremental merge, audit, manifests, lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.scalar import rows
from fleetlake.operators import paths
from fleetlake.operators.sets import dedup_latest, union_all, upsert
from fleetlake.quality.checks import flag_rows
from fleetlake.session import materialise

STATE_SCHEMA = "table_name string, row_count bigint, watermark timestamp"


def stage(
    raw: DataFrame,
    casts: Mapping[str, str],
    defaults: Mapping[str, object],
    keys: Sequence[str],
    order: Sequence[str],
    floors: Mapping[str, float] | None = None,
    names: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Clean a raw frame: trim text, try-cast, fill defaults, clamp, title-case names, drop copies, flag issues."""
    text = {f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"}
    df = raw.withColumns({c: F.trim(c) for c in text})
    df = df.withColumns({c: F.col(c).try_cast(kind) for c, kind in casts.items()})
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    df = df.withColumns({c: F.greatest(F.col(c), F.lit(lo)) for c, lo in (floors or {}).items()})
    df = df.withColumns({c: F.initcap(c) for c in names})
    return flag_rows(dedup_latest(df, keys, order), flags or {})


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Load state (last row count and watermark per table); empty before the first run."""
    try:
        return spark.read.schema(STATE_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], STATE_SCHEMA)


def measure_state(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Current row count and newest timestamp per table."""
    return union_all(
        *[
            df.agg(rows().alias("row_count"), F.max(ts).cast("timestamp").alias("watermark")).select(
                F.lit(name).alias("table_name"), "row_count", "watermark"
            )
            for name, (df, ts) in tables.items()
        ]
    )


def detect_new_rows(current: DataFrame, state: DataFrame) -> DataFrame:
    """Rows added per table since the recorded state, with the action to take."""
    last = state.select("table_name", F.col("row_count").alias("loaded"), F.col("watermark").alias("last_seen"))
    df = current.join(last, "table_name", "left").withColumn("loaded", F.coalesce("loaded", F.lit(0).cast("bigint")))
    fresh = F.col("row_count") - F.col("loaded")
    action = F.when(F.col("loaded") == 0, "full load").when(fresh > 0, "incremental load").when(fresh < 0, "reload").otherwise("up to date")
    return df.select("table_name", "row_count", "loaded", fresh.alias("new_rows"), action.alias("action"))


def after_watermark(df: DataFrame, ts: str, state: DataFrame, table: str) -> DataFrame:
    """Rows from the recorded watermark on; everything when there is none.

    Rows at the watermark itself come again: more of them may have arrived since. The merge
    that follows goes by key, so a row that was loaded before is not doubled.
    """
    seen = state.where(F.col("table_name") == table).agg(F.max("watermark")).scalar()
    return df.where(seen.isNull() | (F.col(ts) >= seen))


def write_months(df: DataFrame, path: str, date: str) -> None:
    """Write partitioned by month; only the months present are replaced.

    The rebalance hint gathers each month into few files and still splits a large one.
    """
    out = df.withColumn("month_key", F.date_format(date, "yyyy-MM")).hint("rebalance", "month_key")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(path)


def merge_months(spark: SparkSession, path: str, delta: DataFrame, date: str, keys: Sequence[str]) -> None:
    """Upsert ``delta`` into a month-partitioned table, rewriting only the touched months.

    Touched are the months of the new rows and the months in which their keys lie so far, so a
    row whose date moved leaves its old month. A month that loses its last row is written empty.
    Months are replaced one after another, so this is for tables nobody reads during the load;
    ``snapshots.merge`` changes a table as a whole.
    """
    fresh = materialise(dedup_latest(delta, keys, [f"-{date}", *[c for c in delta.columns if c != date]]), "delta")
    table = spark.read.parquet(path)
    moved = table.select("month_key", *keys).join(fresh.select(*keys), list(keys), "left_semi").select("month_key")
    touched = materialise(moved.union(fresh.select(F.date_format(date, "yyyy-MM").alias("month_key"))).distinct(), "months")
    # partition pruning happens at run time through the join on the partition column
    old = table.join(touched, "month_key", "left_semi").drop("month_key")
    merged = materialise(upsert(old.select(*delta.columns), fresh, keys), "merge")
    write_months(merged, path, date)
    left = touched.join(merged.select(F.date_format(date, "yyyy-MM").alias("month_key")), "month_key", "left_anti")
    for row in left.collect():  # calendar months, and only those that lost all their rows
        merged.limit(0).write.mode("overwrite").parquet(f"{path}/month_key={row['month_key']}")


def input_inventory(df: DataFrame, kind: str = "parquet") -> DataFrame:
    """Rows and size per input file."""
    files = df.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"))
    return files.groupBy("file_name").agg(rows().alias("row_count"), F.max("file_size").alias("file_size")).withColumn("kind", F.lit(kind))


def run_manifest(df: DataFrame, run_id: str) -> DataFrame:
    """Manifest of the input files one run has consumed."""
    return input_inventory(df).withColumns({"run_id": F.lit(run_id), "state": F.lit("processed")})


def lineage(edges: DataFrame, start: DataFrame, downstream: bool = True, max_depth: int | None = None) -> DataFrame:
    """All nodes reachable from ``start`` (column ``node``) over ``source -> target`` edges, with their depth.

    Known paths double in length with every round (``paths.reach``). A node deeper than a given ``max_depth`` raises.
    """
    a, b = ("source", "target") if downstream else ("target", "source")
    found, _ = paths.reach(edges, start, a, b)
    if max_depth is not None and not found.where(F.col("depth") > max_depth).isEmpty():
        raise ValueError(f"lineage goes deeper than {max_depth} levels")
    return found.where(F.col("depth") > 0).withColumn("depth", F.col("depth").cast("int"))


def eav_pivot(df: DataFrame, key: str, attributes: Mapping[str, str]) -> DataFrame:
    """Attribute rows (``key, attr_name, attr_value``) to one typed row per key; the attribute list fixes the columns."""
    cols = [
        F.max(F.when(F.col("attr_name") == n, F.col("attr_value"))).try_cast(kind).alias(n) for n, kind in attributes.items()
    ]
    return df.groupBy(key).agg(*cols)
