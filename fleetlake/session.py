"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # plain Parquet timestamps load as TIMESTAMP, so filters on them reach the scan
    # and streaming watermarks accept them
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "fleetlake", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLEETLAKE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fleetlake-", dir="/tmp"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of column expressions are only needed while debugging
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local-master session may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("fleetlake.sharedDir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="fleetlake-", dir="/tmp")
    spark.conf.set("fleetlake.sharedDir", folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark)}/fleetlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's part of the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; call it when no frame that reads them is needed any more.

    Results are lazy and may still read them, so this is for the end of a job, not of a query. Other
    applications' folders are not touched. True if there was anything to delete.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and survives lost executors; use it where a frame is read by
    several branches or by every round of an iteration.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
