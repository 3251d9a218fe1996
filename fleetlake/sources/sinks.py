"""Writing: tables, samples, report sheets and mart exports."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = "step string, status string, row_count bigint, seconds double, message string"


def write_table(df: DataFrame, root: str, name: str, key: str, sample: int = 500) -> None:
    """Parquet and CSV copies plus a JSON sample of the first ``sample`` rows in key order."""
    df.write.mode("overwrite").parquet(f"{root}/parquet/{name}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/parquet/{name}")
    stored.write.mode("overwrite").option("header", True).csv(f"{root}/csv/{name}")
    stored.orderBy(key).limit(sample).coalesce(1).write.mode("overwrite").json(f"{root}/json/{name}")


def report_sheets(sheets: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """One directory per report sheet."""
    paths = []
    for name, df in sheets.items():
        path = f"{root}/{name}"
        writer = df.write.mode("overwrite")
        (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
        paths.append(path)
    return paths


def run_steps(spark: SparkSession, steps: Mapping[str, Callable[[], int | None]]) -> DataFrame:
    """Run named steps in order; a failing step is recorded and the rest still run."""
    rows = []
    for name, step in steps.items():
        start = time.time()
        try:
            rows.append((name, "ok", step(), time.time() - start, None))
        except Exception as error:  # noqa: BLE001 - isolation per step is the point
            rows.append((name, "failed", None, time.time() - start, str(error).splitlines()[0][:500]))
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def export_marts(spark: SparkSession, marts: Mapping[str, Callable[[], DataFrame]], root: str) -> DataFrame:
    """Each mart to Parquet and CSV; returns the audit rows."""

    def export(name: str, build: Callable[[], DataFrame]) -> int:
        path = f"{root}/parquet/{name}"
        build().write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        stored.write.mode("overwrite").option("header", True).csv(f"{root}/csv/{name}")
        return stored.agg(F.count(F.lit(1))).first()[0]

    return run_steps(spark, {name: (lambda n=name, b=build: export(n, b)) for name, build in marts.items()})
