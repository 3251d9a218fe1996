"""Structured Streaming jobs: append, upsert, windows, sessions, de-duplication, late rows.

Every job reads a folder, drains what is there (``availableNow``) and keeps its progress
in a checkpoint, so running it again picks up new files only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetlake.operators.sets import dedup_latest


def source(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Schema-checked stream of the files in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def table_of(file_name: Column) -> Column:
    """Target table of a drop file named ``<table>_stream_*``."""
    return F.regexp_extract(F.element_at(F.split(file_name, "/"), -1), r"^(.+?)_stream_", 1)


def drain(stream: DataFrame, checkpoint: str, target: str | None = None, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> None:
    """Run the stream over everything available, into a Parquet folder or a batch function."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", target).start()
    query.awaitTermination()


def append(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Bronze append; the file sink commits each batch once."""
    drain(stream, checkpoint, target=target)


# --- drop folders: load, note what was read, move it away ---


def drain_and_archive(spark: SparkSession, folder: str, schema: T.StructType, target: str, manifest: str, archive: str, checkpoint: str, run_id: str, fmt: str = "parquet", files_per_batch: int | None = None) -> int:
    """Load the files of a drop folder into ``target`` once, note them in ``manifest`` and move them to ``archive``; returns the files moved.

    The steps can be repeated after a failure at any point. Each batch writes its rows and its part
    of the manifest under its number, so a replayed batch replaces itself. Files move only when their
    batch is in the manifest and committed; a file that is in the archive already is not moved again, and the
    next run moves what a lost run left behind. Rows of a file are loaded once, though the file may still lie in the folder.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.drop("file_path").write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
            files = batch.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"))
            files.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").parquet(f"{manifest}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    stream = source(spark, folder, schema, fmt, files_per_batch).select("*", F.col("_metadata.file_path").alias("file_path"))
    drain(stream, checkpoint, each=load)
    return move_files(spark, read_manifest(spark, manifest), archive)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """file_path, file_name, row_count, run_id, batch_id of every file loaded so far; empty before the first run."""
    schema = "file_path string, row_count bigint, run_id string, batch_id int"
    try:
        noted = spark.read.schema(schema).parquet(manifest)
    except AnalysisException:
        noted = spark.createDataFrame([], schema)
    return noted.withColumn("file_name", F.element_at(F.split("file_path", "/"), -1))


def move_files(spark: SparkSession, noted: DataFrame, archive: str) -> int:
    """Rename the noted files that are still in place into ``archive``; returns their number.

    Names come one partition at a time. A file goes below its batch number, so equal names of different runs do not meet.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    moved = 0
    for row in noted.select("file_path", "file_name", "batch_id").toLocalIterator():
        old, new = hadoop.Path(row["file_path"]), hadoop.Path(f"{archive}/batch_id={row['batch_id']}/{row['file_name']}")
        fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(old):
            fs.mkdirs(new.getParent())
            if not fs.rename(old, new):
                raise RuntimeError(f"{old}: not moved to {new}")
            moved += 1
    return moved


# --- upsert log: one folder per batch, newest row per key wins on read ---


def write_batch(target: str) -> Callable[[DataFrame, int], None]:
    """Batch function that stores a batch under its number; a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return write


def upsert(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Idempotent merge by key: writes only the delta; ``current`` resolves it."""
    drain(stream, checkpoint, each=write_batch(target), mode=mode)


def current(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key of an upsert log."""
    log = spark.read.parquet(target)
    return dedup_latest(log, keys, [*order, "-batch_id"]).drop("batch_id")


def compact(spark: SparkSession, target: str, into: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Rewrite a log as one resolved batch in a new folder."""
    current(spark, target, keys, order).write.mode("errorifexists").parquet(f"{into}/batch_id=0")


# --- event-time operators ---


def tumbling(stream: DataFrame, ts: str, size: str, delay: str, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Measures per window and key; a window is emitted once the watermark has passed its end."""
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, size), *keys).agg(*[c.alias(n) for n, c in measures.items()])
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures)


def sliding(stream: DataFrame, ts: str, size: str, step: str, delay: str, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Measures per overlapping window and key."""
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, size, step), *keys).agg(*[c.alias(n) for n, c in measures.items()])
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures)


def sessions(stream: DataFrame, ts: str, gap: str, delay: str, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Measures per session; a gap of inactivity closes it."""
    g = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(*[c.alias(n) for n, c in measures.items()])
    return g.select(F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *keys, *measures)


def dedup(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """First row per key within the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def split_late(ts: str, delay: str, accepted: str, late: str, progress: str) -> Callable[[DataFrame, int], None]:
    """Batch function: rows older than the newest time of earlier batches less ``delay`` go to the late log.

    The newest time per batch is stored under the batch number, so a replay decides alike.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            earlier = spark.read.schema("newest timestamp, batch_id bigint").parquet(progress).where(F.col("batch_id") < batch_id)
            newest = earlier.agg(F.max("newest")).first()[0]
        except AnalysisException:
            newest = None
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        is_late = F.coalesce(F.col(ts) < limit, F.lit(False))
        batch = batch.persist()
        try:
            batch.where(~is_late).write.mode("overwrite").parquet(f"{accepted}/batch_id={batch_id}")
            batch.where(is_late).write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")
            batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return split


def running_kpi(stream: DataFrame, key: str, ts: str, tie: str, value: str) -> DataFrame:
    """Running count and latest value per key (update mode; state is one row per key)."""
    at = F.struct(ts, tie)
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max_by(value, at).alias("last_value"), F.max(ts).alias("last_seen"))


_EPISODE = "since bigint, n bigint, seen bigint, tie bigint"


def expiring_kpi(stream: DataFrame, key: str, ts: str, tie: str, value: str, delay: str, idle_seconds: int) -> DataFrame:
    """Running count and latest value per key and episode; idle keys leave the state (update mode).

    An episode of a key ends when no event follows its last one within ``idle_seconds``. When the watermark passes that
    moment a timer closes it: a last row with ``closed`` comes out and the state of the key is removed, so the
    state holds the keys seen lately and not all keys ever. An event after a longer gap opens the next episode,
    also before the timer has fired. Events of a key must arrive in order up to ``delay``; older ones are
    dropped by the watermark. Of events at one time the largest ``tie`` (a whole number) is the latest.
    Columns: key, since (first event), n, last_value, last_seen, closed. Rows with a NULL key or time are left out.
    """
    kind, number = stream.schema[key].dataType.simpleString(), stream.schema[value].dataType.simpleString()
    schema = f"{key} {kind}, since timestamp, n bigint, last_value {number}, last_seen timestamp, closed boolean"
    idle = idle_seconds * 1_000_000
    names = [key, "since", "n", "last_value", "last_seen", "closed"]

    def work(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, n, seen, last_tie, last = state.get if state.exists else (None, 0, None, None, None)
        rows = []

        def row(closed: bool) -> None:
            rows.append((group[0], pd.Timestamp(since, unit="us"), n, last, pd.Timestamp(seen, unit="us"), closed))

        if state.hasTimedOut:
            row(True)
            state.remove()
        else:
            events = pd.concat(list(frames)).sort_values(["at", "tie"])
            for at, order, v in zip(events["at"].tolist(), events["tie"].tolist(), events["value"].tolist()):
                if n and at > seen + idle:
                    row(True)
                    since, n, seen, last_tie, last = None, 0, None, None, None
                n += 1
                since = at if since is None else min(since, at)
                if seen is None or (at, order) >= (seen, last_tie):
                    seen, last_tie, last = at, order, v
            row(False)
            state.update((since, n, seen, last_tie, last))
            # a moment that the watermark has passed already can be no timer: the next moment is
            state.setTimeoutTimestamp(max(-(-(seen + idle) // 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=names)

    known = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    plain = known.select(F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.col(tie).cast("bigint").alias("tie"), F.col(value).alias("value"), F.col(ts))
    return plain.groupBy("key").applyInPandasWithState(work, schema, f"{_EPISODE}, last {number}", "update", GroupStateTimeout.EventTimeTimeout)


def live_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys a stateful job holds at present, read from its checkpoint: columns ``key`` and ``value``."""
    return spark.read.format("statestore").load(checkpoint).select("key", "value")
