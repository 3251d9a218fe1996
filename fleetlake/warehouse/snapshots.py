"""Month tables that are loaded incrementally and always readable: files beside the table, one manifest swap.

A load writes the months it touches into a folder of its own and then one manifest, which says for
every month where its files lie. Readers follow the newest manifest. Until that appears, nothing has
changed: a run that dies leaves the old table, and its folder is removed by ``vacuum``. Writing a manifest that is
there already fails, so of two loads at the same time one has to start again.

An index of (keys, month), dealt into buckets by a hash of the keys, tells in which month a key lies so far.
A load reads and rewrites the buckets of its own keys only, not the keys of the whole table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.scalar import rows
from fleetlake.operators.sets import dedup_latest
from fleetlake.session import materialise

BUCKETS = 64
NO_MONTH = "none"  # rows without a date


class Conflict(RuntimeError):
    """Another load has committed since this one began."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    return [int(n[1:]) for n in _names(spark, f"{root}/manifests") if n.startswith("v")]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest of a version, by default the newest."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise ValueError(f"{root}: no version {version}" if known else f"{root}: no table")
    fs, p = _fs(spark, f"{root}/manifests/v{version or known[-1]:08d}")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, entry: dict) -> None:
    """Make a manifest appear as a whole; fails if its version is taken."""
    name = f"v{entry['version']:08d}"
    fs, draft = _fs(spark, f"{root}/manifests/.{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(hadoop.Options.Rename, "NONE")
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, hadoop.Path(f"{root}/manifests/{name}"), options)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{root}: version {entry['version']} is there already") from e
        raise


def _month(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join in which NULL keys match each other."""
    other = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(other, on, how)


def _write(df: DataFrame, by: str, path: str) -> None:
    """One folder per value of ``by``; the hint gathers each into few files and still splits a large one."""
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def _written(spark: SparkSession, path: str, by: str) -> dict[str, str]:
    """Folders that a write made: value -> path."""
    return {n.split("=", 1)[1]: f"{path}/{n}" for n in _names(spark, path) if n.startswith(f"{by}=")}


def create(df: DataFrame, root: str, date: str, keys: Sequence[str], buckets: int = BUCKETS) -> dict:
    """Write ``df`` (one row per key) as version 1 of a new table; returns its manifest.

    ``buckets`` is the number of parts of the key index; about one part per million keys keeps a part within a task.
    """
    spark = df.sparkSession
    if versions(spark, root):
        raise Conflict(f"{root}: there is a table already")
    marked = df.withColumns({"month_key": _month(date), "bucket": _bucket(keys, buckets)})
    folder = f"{root}/loads/{uuid.uuid4().hex}"
    _write(marked.drop("bucket"), "month_key", f"{folder}/data")
    _write(marked.select(*keys, "month_key", "bucket"), "bucket", f"{folder}/index")
    months, index = _written(spark, f"{folder}/data", "month_key"), _written(spark, f"{folder}/index", "bucket")
    entry = {"version": 1, "date": date, "keys": list(keys), "buckets": buckets, "schema": df.schema.json(), "months": months, "index": index, "run": None, "touched": sorted(months), "read_buckets": 0}
    _commit(spark, root, entry)
    return entry


def merge(delta: DataFrame, root: str, run: str | None = None) -> dict:
    """Upsert ``delta`` by key: the next version's manifest. Rows whose date moved leave their old month.

    Of several delta rows with one key the latest date counts. A ``run`` that committed last is not
    applied again, so a job that died after its commit can simply be repeated. An empty delta changes nothing.
    """
    spark = delta.sparkSession
    last = manifest(spark, root)
    if run is not None and last["run"] == run:
        return last
    date, keys, schema = last["date"], last["keys"], T.StructType.fromJson(json.loads(last["schema"]))
    order = [f"-{date}", *[c for c in schema.fieldNames() if c != date and c not in keys]]
    marked = dedup_latest(delta.select(*schema.fieldNames()), keys, order).withColumns({"month_key": _month(date), "bucket": _bucket(keys, last["buckets"])})
    fresh = materialise(marked, "snapshot-delta")
    new = fresh.agg(F.collect_set("month_key").alias("months"), F.collect_set("bucket").alias("buckets")).first()  # calendar months and parts of the index
    if not new["buckets"]:
        return last
    hit = {str(b) for b in new["buckets"]}
    known = _index(spark, last, [b for b in hit if b in last["index"]], schema)
    old = _same(keys, known, fresh.select(*keys), "left_semi").select("month_key").distinct().collect()
    touched = {r["month_key"] for r in old} | set(new["months"])
    stays = read(spark, root, months=sorted(touched & set(last["months"])), entry=last)
    folder = f"{root}/loads/{uuid.uuid4().hex}"
    kept = _same(keys, stays, fresh.select(*keys), "left_anti").withColumn("month_key", _month(date))
    _write(kept.unionByName(fresh.drop("bucket")), "month_key", f"{folder}/data")
    others = _same(keys, known, fresh.select(*keys), "left_anti").withColumn("bucket", _bucket(keys, last["buckets"]))
    _write(others.unionByName(fresh.select(*keys, "month_key", "bucket")), "bucket", f"{folder}/index")
    months = {m: p for m, p in last["months"].items() if m not in touched} | _written(spark, f"{folder}/data", "month_key")
    index = {b: p for b, p in last["index"].items() if b not in hit} | _written(spark, f"{folder}/index", "bucket")
    entry = last | {"version": last["version"] + 1, "months": months, "index": index, "run": run, "touched": sorted(touched), "read_buckets": len(hit)}
    _commit(spark, root, entry)
    return entry


def _index(spark: SparkSession, entry: dict, buckets: Sequence[str], schema: T.StructType) -> DataFrame:
    own = T.StructType([*[schema[k] for k in entry["keys"]], T.StructField("month_key", T.StringType())])
    if not buckets:
        return spark.createDataFrame([], own)
    return spark.read.schema(own).parquet(*[entry["index"][b] for b in sorted(buckets)])


def read(spark: SparkSession, root: str, version: int | None = None, months: Sequence[str] | None = None, entry: dict | None = None) -> DataFrame:
    """The rows of a version, by default the newest; ``months`` (``yyyy-MM``) opens the files of these only."""
    entry = entry or manifest(spark, root, version)
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    paths = [p for m, p in sorted(entry["months"].items()) if months is None or m in set(months)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per version: months in the table, months and index parts the load rewrote, the run."""
    out = []
    for v in versions(spark, root):
        e = manifest(spark, root, v)
        out.append((v, len(e["months"]), len(e["touched"]), e["read_buckets"], e["buckets"], e["run"]))
    return spark.createDataFrame(out, "version int, months int, rewritten_months int, rewritten_buckets int, buckets int, run string")


def find(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` keys with the month they lie in, from the index alone; keys that are not there are left out."""
    entry = manifest(spark, root)
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    asked = wanted.select(*entry["keys"]).distinct()
    hit = {str(r["b"]) for r in asked.select(_bucket(entry["keys"], entry["buckets"]).alias("b")).distinct().collect()}
    return _same(entry["keys"], _index(spark, entry, [b for b in hit if b in entry["index"]], schema), asked, "left_semi")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove manifests beyond the newest ``keep`` and the folders of loads no kept manifest names; returns the number of folders.

    Run it when no load is under way: the folder of a load that has not committed yet is named nowhere.
    """
    if keep < 1:
        raise ValueError("keep at least the newest version")
    known = versions(spark, root)
    for v in known[:-keep]:
        fs, p = _fs(spark, f"{root}/manifests/v{v:08d}")
        fs.delete(p, False)
    named = set()
    for v in known[-keep:]:
        e = manifest(spark, root, v)
        named |= {p.split("/loads/")[1].split("/")[0] for p in [*e["months"].values(), *e["index"].values()]}
    gone = [n for n in _names(spark, f"{root}/loads") if n not in named]
    for n in gone:
        fs, p = _fs(spark, f"{root}/loads/{n}")
        fs.delete(p, True)
    return len(gone)


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per version and month, from the files of each version."""
    out = None
    for v in versions(spark, root):
        e = manifest(spark, root, v)
        part = read(spark, root, entry=e).groupBy(_month(e["date"]).alias("month_key")).agg(rows().alias("row_count")).withColumn("version", F.lit(v))
        out = part if out is None else out.unionByName(part)
    return out
