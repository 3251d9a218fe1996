"""Stateful running figures with expiry of idle keys."""

from datetime import datetime, timedelta

from fleetlake.session import scratch_path
from fleetlake.streaming import streams

SCHEMA = "k string, ts timestamp, id bigint, v double"
START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def feed(spark, folder, n, rows):
    spark.createDataFrame([(k, None if h is None else at(h), i, float(i)) for k, h, i in rows], SCHEMA).coalesce(1).write.parquet(f"{folder}/part{n}")


def drained(spark, folder, out, state):
    stream = streams.source(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    streams.upsert(streams.expiring_kpi(stream, "k", "ts", "id", "v", "1 hour", 10 * 3600), out, state, mode="update")
    now = streams.current(spark, out, ["k", "since"], ["-closed", "-n"])
    return sorted((r.k, (r.since - START) // timedelta(hours=1), r.n, r.last_value, (r.last_seen - START) // timedelta(hours=1), r.closed) for r in now.collect())


def test_idle_keys_leave_the_state_and_return(spark):
    folder, out, state = (scratch_path(spark, f"expiry-{x}") for x in ("in", "out", "state"))
    feed(spark, folder, 0, [("a", 0, 1), ("b", 0, 2), ("a", 3, 4), ("a", 3, 3), (None, 1, 9), ("c", None, 8)])
    assert drained(spark, folder, out, state) == [("a", 0, 3, 4.0, 3, False), ("b", 0, 1, 2.0, 0, False)]
    assert {r.key.key for r in streams.live_state(spark, state).collect()} == {"a", "b"}
    # the watermark passes 0 + 10 and 3 + 10 hours: both keys go, only c stays
    feed(spark, folder, 1, [("c", 30, 5)])
    assert drained(spark, folder, out, state) == [("a", 0, 3, 4.0, 3, True), ("b", 0, 1, 2.0, 0, True), ("c", 30, 1, 5.0, 30, False)]
    assert {r.key.key for r in streams.live_state(spark, state).collect()} == {"c"}
    # a returns: a new episode
    feed(spark, folder, 2, [("a", 31, 6), ("c", 39, 7)])
    got = drained(spark, folder, out, state)
    assert ("a", 31, 1, 6.0, 31, False) in got and ("a", 0, 3, 4.0, 3, True) in got and ("c", 30, 2, 7.0, 39, False) in got
    # nothing new: nothing changes
    assert drained(spark, folder, out, state) == got


def test_a_gap_within_one_batch_opens_a_new_episode(spark):
    folder, out, state = (scratch_path(spark, f"gap-{x}") for x in ("in", "out", "state"))
    feed(spark, folder, 0, [("a", 0, 1), ("a", 10, 2), ("a", 21, 3), ("a", 22, 4)])
    assert drained(spark, folder, out, state) == [("a", 0, 2, 2.0, 10, True), ("a", 21, 2, 4.0, 22, False)]


def drop(spark, inbox, ids):
    spark.createDataFrame([(str(i), START, i, 0.0) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def names(spark, folder):
    return sorted(r[0] for r in spark.read.schema(SCHEMA).parquet(folder).select("_metadata.file_name").distinct().collect())


def test_drained_files_are_archived_once(spark, monkeypatch):
    root = scratch_path(spark, "archive-test")
    inbox, target, manifest, archive, state = (f"{root}/{x}" for x in ("inbox", "target", "manifest", "archive", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(name):
        return streams.drain_and_archive(spark, inbox, schema, target, manifest, archive, state, name, files_per_batch=1)

    drop(spark, inbox, range(5))
    drop(spark, inbox, range(5, 8))
    assert run("one") == 2
    assert run("again") == 0
    assert names(spark, f"{archive}/*") == sorted(r.file_name for r in streams.read_manifest(spark, manifest).collect())
    # a run that dies after loading and before moving: the next one moves, and loads nothing twice
    drop(spark, inbox, range(8, 10))
    move = streams.move_files
    monkeypatch.setattr(streams, "move_files", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        run("lost")
    except RuntimeError:
        pass
    monkeypatch.setattr(streams, "move_files", move)
    assert run("next") == 1
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(10))
    got = {r.run_id: r.row_count for r in streams.read_manifest(spark, manifest).groupBy("run_id").sum("row_count").toDF("run_id", "row_count").collect()}
    assert got == {"one": 8, "lost": 2}
    assert names(spark, f"{archive}/*") == sorted(r.file_name for r in streams.read_manifest(spark, manifest).collect())
