"""Streaming jobs over the event table, replayed from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.catalog.adapters import profile_of
from fleetlake.catalog.etl import SHIFTED_PRICES
from fleetlake.catalog.registry import D, S, TS, query
from fleetlake.constants import FUEL_PRICE_TIMELINE
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import dsum, rows
from fleetlake.operators.joins import price_steps
from fleetlake.session import scratch_path
from fleetlake.streaming import streams

DELAY = "1 day"
CLOSED = "(SELECT MAX(ts) - INTERVAL 1 DAY FROM events)"


def events(t):
    """The events table's own files as a stream; a glob, since the table may be one file or a folder of files."""
    return streams.source(t.spark, f"{t.root}/events.parque[t]", t["events"].schema)


def run(t, label, build, mode="append"):
    """Stream the events through ``build`` into a folder and return what arrived."""
    out, state = scratch_path(t.spark, label), scratch_path(t.spark, f"{label}-state")
    streams.drain(build(events(t)), state, target=out, mode=mode)
    return t.spark.read.parquet(out)


@query("stream_files", "SELECT 'events' AS table_name, event_type, COUNT(*) AS n FROM events GROUP BY 2")
def _(t):
    folder = scratch_path(t.spark, "drops")
    for i, part in enumerate(t["events"].randomSplit([0.5, 0.5], seed=1)):
        part.write.option("header", True).csv(f"{folder}/events_stream_{i}")
    out, state = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "bronze-state")
    drops = streams.source(t.spark, f"{folder}/*", t["events"].schema, "csv")
    # the drop folder carries the table name
    name = F.regexp_extract(F.input_file_name(), r"/([^/]+?)_stream_[^/]*/[^/]*$", 1)
    streams.drain(drops.withColumn("table_name", name), state, target=out)
    return t.spark.read.parquet(out).groupBy("table_name", "event_type").agg(rows().alias("n"))


@query("stream_append", f"SELECT event_id, user_id, event_type, value, {TS('ts')} AS ts FROM events")
def _(t):
    out, state = scratch_path(t.spark, "append"), scratch_path(t.spark, "append-state")
    for _ in range(2):  # the second run finds nothing new
        streams.append(events(t), out, state)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value", "ts")


@query("stream_upsert", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    # every event arrives twice, the earlier copy with an outdated value
    folder = scratch_path(t.spark, "inbox")
    e = t["events"].withColumn("version", F.lit(2))
    old = t["events"].withColumns({"version": F.lit(1), "value": F.col("value") - 1})
    old.unionByName(e).write.parquet(folder)
    out, state = scratch_path(t.spark, "upsert"), scratch_path(t.spark, "upsert-state")
    streams.upsert(streams.source(t.spark, folder, e.schema), out, state)
    small = scratch_path(t.spark, "upsert-compacted")
    streams.compact(t.spark, out, small, ["event_id"], ["-version"])
    return streams.current(t.spark, small, ["event_id"], ["-version"]).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_tumbling",
    f"""SELECT {TS("DATE_TRUNC('hour', ts)")} AS window_start, {TS("DATE_TRUNC('hour', ts) + INTERVAL 1 HOUR")} AS window_end, event_type, COUNT(*) AS n, {S('value')} AS total FROM events
        GROUP BY DATE_TRUNC('hour', ts), event_type HAVING DATE_TRUNC('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}""",
)
def _(t):
    return run(t, "tumbling", lambda s: streams.tumbling(s, "ts", "1 hour", DELAY, ["event_type"], {"n": rows(), "total": dsum("value")}))


@query(
    "stream_sliding",
    f"""SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 7 DAY AS VARCHAR) AS window_end, COUNT(*) AS n FROM (SELECT ts, CAST(DATE_TRUNC('day', ts) - UNNEST(GENERATE_SERIES(0, 6)) * INTERVAL 1 DAY AS TIMESTAMP) AS w FROM events)
        GROUP BY w HAVING w + INTERVAL 7 DAY <= {CLOSED}""",
)
def _(t):
    return run(t, "sliding", lambda s: streams.sliding(s, "ts", "7 days", "1 day", DELAY, [], {"n": rows()}))


_SESSIONS = """(SELECT user_id, MIN(ts) AS s, MAX(ts) + INTERVAL 12 HOUR AS e, COUNT(*) AS n FROM (SELECT user_id, ts, SUM(CASE WHEN p IS NULL OR ts - p >= INTERVAL 12 HOUR THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)) GROUP BY user_id, k)"""


@query("stream_session", f"SELECT user_id, {TS('s')} AS session_start, {TS('e')} AS session_end, n FROM {_SESSIONS} WHERE e <= {CLOSED}")
def _(t):
    return run(t, "session", lambda s: streams.sessions(s, "ts", "12 hours", DELAY, ["user_id"], {"n": rows()}))


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    folder = scratch_path(t.spark, "inbox")
    t["events"].unionByName(t["events"]).write.parquet(folder)
    out, state = scratch_path(t.spark, "dedup"), scratch_path(t.spark, "dedup-state")
    s = streams.source(t.spark, folder, t["events"].schema)
    streams.drain(streams.dedup(s, "ts", DELAY, ["event_id"]), state, target=out)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type")


_HALF = "2024-01-16"


@query(
    "stream_late",
    f"""SELECT event_type, COUNT(*) FILTER (WHERE ts >= {CLOSED} OR ts >= TIMESTAMP '{_HALF}') AS accepted, COUNT(*) FILTER (WHERE ts < {CLOSED} AND ts < TIMESTAMP '{_HALF}') AS late FROM events GROUP BY 1""",
)
def _(t):
    # the newer half arrives first, so the older half is late
    folder, half = scratch_path(t.spark, "inbox"), F.lit(_HALF).cast("timestamp")
    out = {n: scratch_path(t.spark, n) for n in ("accepted", "late", "progress", "late-state")}
    each = streams.split_late("ts", DELAY, out["accepted"], out["late"], out["progress"])
    for part in (F.col("ts") >= half, F.col("ts") < half):
        t["events"].where(part).write.mode("append").parquet(folder)
        streams.drain(streams.source(t.spark, folder, t["events"].schema), out["late-state"], each=each)
    schema = t["events"].schema
    accepted = t.spark.read.schema(schema).parquet(out["accepted"]).select("event_type", F.lit(1).alias("a"), F.lit(0).alias("l"))
    late = t.spark.read.schema(schema).parquet(out["late"]).select("event_type", F.lit(0).alias("a"), F.lit(1).alias("l"))
    return accepted.unionByName(late).groupBy("event_type").agg(F.sum("a").alias("accepted"), F.sum("l").alias("late"))


def _price_sql():
    whens = " ".join(f"WHEN CAST(ts AS DATE) >= DATE '{r[0]}' THEN {r[1]}::DOUBLE" for r in sorted(FUEL_PRICE_TIMELINE, reverse=True))
    return f"CASE {whens} ELSE 220.0::DOUBLE END"


@query("stream_dim_join", f"SELECT event_id, e.user_id, profile, {_price_sql()} AS price FROM events e JOIN telem_drivers d ON e.user_id = d.driver_id")
def _(t):
    petrol = [(r[0], r[1]) for r in FUEL_PRICE_TIMELINE]
    dim = t["telem_drivers"].withColumnRenamed("driver_id", "user_id")

    def build(s):
        return s.join(dim, "user_id").select("event_id", "user_id", "profile", price_steps(petrol, F.to_date("ts"), 220.0).alias("price"))

    return run(t, "enriched", build)


@query(
    "stream_running_kpi",
    f"SELECT user_id, COUNT(*) AS n, ARG_MAX(value, ts) AS last_value, {TS('MAX(ts)')} AS last_seen FROM events GROUP BY 1",
)
def _(t):
    out, state = scratch_path(t.spark, "running"), scratch_path(t.spark, "running-state")
    streams.upsert(streams.running_kpi(events(t), "user_id", "ts", "event_id", "value"), out, state, mode="update")
    return streams.current(t.spark, out, ["user_id"], ["-n"])


IDLE_HOURS = 36


@query(
    "stream_expiring_kpi",
    f"""WITH g AS (SELECT *, ts - LAG(ts) OVER w > INTERVAL {IDLE_HOURS} HOUR AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        e AS (SELECT *, SUM(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS episode FROM g)
        SELECT user_id, {TS('MIN(ts)')} AS since, COUNT(*) AS n, ARG_MAX(value, (ts, event_id)) AS last_value, {TS('MAX(ts)')} AS last_seen,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY MIN(ts) DESC) > 1 OR MAX(ts) + INTERVAL {IDLE_HOURS} HOUR < {CLOSED} AS closed FROM e GROUP BY user_id, episode""",
)
def _(t):
    # four files in the order of time, one per batch; timers close what has gone idle between them
    folder, out, state = (scratch_path(t.spark, f"expiring{x}") for x in ("", "-out", "-state"))
    cuts = t["events"].select(F.percentile_approx("ts", [0.25, 0.5, 0.75], 1000).alias("c")).first()["c"]
    for i, (a, b) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = t["events"] if a is None else t["events"].where(F.col("ts") >= a)
        (part if b is None else part.where(F.col("ts") < b)).coalesce(1).write.parquet(f"{folder}/part{i}")
    stream = streams.source(t.spark, f"{folder}/*", t["events"].schema, files_per_batch=1)
    streams.upsert(streams.expiring_kpi(stream, "user_id", "ts", "event_id", "value", DELAY, IDLE_HOURS * 3600), out, state, mode="update")
    return streams.current(t.spark, out, ["user_id", "since"], ["-closed", "-n"])


@query(
    "stream_archive",
    """SELECT run, COUNT(*) AS row_count, CAST(2 AS BIGINT) AS files_noted, CAST(2 AS BIGINT) AS files_archived, CAST(0 AS BIGINT) AS files_left, 0 AS read_again FROM
        (SELECT CASE WHEN event_id % 4 < 2 THEN 'run-1' ELSE 'run-2' END AS run FROM events) GROUP BY run""",
)
def _(t):
    # two runs with two files each, and after each a run that finds nothing
    root = scratch_path(t.spark, "drop-folder")
    inbox, target, manifest, archive, state = (f"{root}/{x}" for x in ("inbox", "events", "manifest", "archive", "state"))
    again = {}
    for run in (1, 2):
        for i in (0, 1):
            t["events"].where(F.col("event_id") % 4 == 2 * run - 2 + i).coalesce(1).write.mode("append").parquet(inbox)
        streams.drain_and_archive(t.spark, inbox, t["events"].schema, target, manifest, archive, state, f"run-{run}")
        again[f"run-{run}"] = streams.drain_and_archive(t.spark, inbox, t["events"].schema, target, manifest, archive, state, f"run-{run}-again")
    noted = streams.read_manifest(t.spark, manifest)
    kept = t.spark.read.schema(t["events"].schema).parquet(f"{archive}/*").select(F.col("_metadata.file_name").alias("file_name")).distinct().withColumn("archived", F.lit(1))
    left = t.spark.read.schema(t["events"].schema).parquet(inbox).select(F.col("_metadata.file_name").alias("file_name")).distinct().withColumn("left", F.lit(1))
    joined = noted.join(kept, "file_name", "left").join(left, "file_name", "left")
    found = joined.groupBy(F.col("run_id").alias("run")).agg(F.sum("row_count").alias("row_count"), rows().alias("files_noted"), F.count("archived").alias("files_archived"), F.count("left").alias("files_left"))
    return found.join(t.spark.createDataFrame(list(again.items()), "run string, read_again int"), "run")
