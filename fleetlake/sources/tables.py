"""Loading: Parquet or CSV tables, type repair, calendar columns, SQL views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.scalar import is_weekend


def load_table(spark: SparkSession, root: str, name: str, csv_schema: T.StructType | None = None) -> DataFrame:
    """One table below ``root``: ``name.parquet``, else ``name.csv`` with a schema."""
    try:
        return spark.read.parquet(f"{root}/{name}.parquet")
    except AnalysisException:
        if csv_schema is None:
            raise
        return read_csv(spark, f"{root}/{name}.csv", csv_schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV read; values that do not parse become NULL."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)


def load_all(
    spark: SparkSession, root: str, names: Sequence[str], schemas: Mapping[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Lazy frames by name; nothing is read until an action needs it."""
    schemas = schemas or {}
    return {name: load_table(spark, root, name, schemas.get(name)) for name in names}


def normalise_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parse text columns to timestamps; bad values become NULL. Typed columns stay."""
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in text})


def derive_calendar(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Year, month label, week range, day name, hour and weekend flag of ``ts``."""
    c = F.col(ts)
    monday = F.to_date(F.date_trunc("week", c))
    return df.withColumns(
        {
            f"{prefix}year": F.year(c),
            f"{prefix}month": F.date_format(c, "yyyy-MM"),
            f"{prefix}week": F.concat(
                F.date_format(monday, "yyyy-MM-dd"), F.lit("/"), F.date_format(F.date_add(monday, 6), "yyyy-MM-dd")
            ),
            f"{prefix}hour": F.hour(c),
            f"{prefix}dow": F.date_format(c, "EEEE"),
            f"{prefix}is_weekend": is_weekend(c),
        }
    )


def register_tables(tables: Mapping[str, DataFrame]) -> list[str]:
    """Expose frames to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def sql_query(spark: SparkSession, text: str, args: Sequence | Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with bound parameters; ``{name}`` in the text refers to a frame argument."""
    return spark.sql(text, args=args, **frames)


def raw_csv_view(spark: SparkSession, path: str, schema: T.StructType | str, view: str) -> DataFrame:
    """Typed view over CSV files."""
    df = read_csv(spark, path, schema)
    df.createOrReplaceTempView(view)
    return df


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for every table, one pass per table."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def table_inventory(
    tables: Mapping[str, DataFrame],
    primary: Mapping[str, Sequence[str]] | None = None,
    foreign: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per column: type, PK/FK tag and the table's row count."""
    primary, foreign = primary or {}, foreign or {}
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in sorted(tables.items()):
        for pos, f in enumerate(df.schema.fields, start=1):
            tag = "PK" if f.name in primary.get(name, ()) else "FK" if f.name in foreign.get(name, ()) else ""
            rows.append((name, pos, f.name, f.dataType.simpleString(), tag))
    columns = spark.createDataFrame(
        rows, "table_name string, position int, column_name string, column_type string, key_tag string"
    )
    return columns.join(table_row_counts(tables), "table_name")


def preview(df: DataFrame, n: int, key: str) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def json_field(column: str, path: str) -> Column:
    """Scalar field of a JSON document column."""
    return F.get_json_object(F.col(column), path)
