"""Data-quality checks: summaries, rule tables, row flags, issue logs, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.scalar import count_if, pct, rows
from fleetlake.operators import scale
from fleetlake.operators.sets import union_all


def null_summary(df: DataFrame, name: str, bad_key: Column, bad_value: Column) -> DataFrame:
    """Rows, bad keys, bad values and their share for one table, in one pass."""
    return df.agg(
        rows().alias("total"), count_if(bad_key).alias("null_key"), count_if(bad_value).alias("bad_value"),
        pct(count_if(bad_value), rows()).alias("issue_pct"),
    ).select(F.lit(name).alias("table_name"), "*")


def any_null(df: DataFrame) -> Column:
    out = F.lit(False)
    for c in df.columns:
        out = out | F.col(f"`{c}`").isNull()
    return out


def table_summary(df: DataFrame, name: str) -> DataFrame:
    """Whole-table scan: rows, rows with a NULL, surplus copies, issue % and its grade.

    Rows are compared by a 128-bit fingerprint, so one shuffle of two numbers per row
    covers tables with long texts.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    prints = df.select(
        F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit("second"), *cols, F.lit("print")).alias("_h2"), any_null(df).alias("_null")
    )
    out = prints.groupBy("_h1", "_h2", "_null").agg(rows().alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )
    issue = F.coalesce(pct("null_rows", "total"), F.lit(0.0))
    grade = F.when(issue <= 1, "Good").when(issue <= 5, "Acceptable").otherwise("Bad")
    return out.select(F.lit(name).alias("table_name"), "*", issue.alias("issue_pct"), grade.alias("status"))


@dataclass(frozen=True)
class Rule:
    """One data test.

    ``kind``: not_null, range (low, high), accepted_values (values), format (pattern),
    unique, referential (parent, parent_column), scd2 (one current row per key and no
    overlap), threshold (at most ``limit`` percent of rows fail ``condition``).
    """

    name: str
    kind: str
    column: str
    options: Mapping = field(default_factory=dict)


def _violation(rule: Rule) -> Column:
    c, o = F.col(rule.column), rule.options
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "range":
        return c.isNotNull() & ~c.between(o["low"], o["high"])
    if rule.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*o["values"])
    if rule.kind == "format":
        return c.isNotNull() & ~c.rlike(o["pattern"])
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def scd2_violations(dim: DataFrame, key: str) -> DataFrame:
    """Per key: current rows other than one, or versions that overlap."""
    order = ["valid_from", "valid_to"]
    seen = scale.bounded(dim.select(key, *order, "is_current"), [key], order, {"_prev": lambda w: F.lag("valid_to").over(w)})
    overlap = F.col("_prev") >= F.col("valid_from")
    bad = (count_if(F.col("is_current")) != 1) | (count_if(overlap) > 0)
    return seen.groupBy(key).agg(bad.alias("_bad"))


def run_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """``table_name, rule, checked, failed, passed``; all row rules share one scan."""
    row_rules = [r for r in rules if r.kind in ("not_null", "range", "accepted_values", "format", "threshold")]
    parts = []

    def result(one: DataFrame, name: str) -> DataFrame:
        return one.select(
            F.lit(table).alias("table_name"), F.lit(name).alias("rule"), "checked", "failed", (F.col("failed") == 0).alias("passed")
        )

    if row_rules:
        measures = [rows().alias("_n")]
        for i, r in enumerate(row_rules):
            bad = r.options["condition"] if r.kind == "threshold" else _violation(r)
            measures.append(count_if(bad).alias(f"_f{i}"))
        cells = []
        for i, r in enumerate(row_rules):
            failed = F.col(f"_f{i}")
            ok = failed == 0
            if r.kind == "threshold":
                ok = F.coalesce(pct(failed, "_n"), F.lit(0.0)) <= r.options["limit"]
            cells.append(
                F.struct(F.lit(table).alias("table_name"), F.lit(r.name).alias("rule"), F.col("_n").alias("checked"), failed.alias("failed"), ok.alias("passed"))
            )
        parts.append(df.agg(*measures).select(F.inline(F.array(*cells))))
    for r in rules:
        if r.kind == "unique":
            per = df.groupBy(r.column).agg(rows().alias("_n"))
            parts.append(result(per.agg(F.sum("_n").alias("checked"), count_if(F.col("_n") > 1).alias("failed")), r.name))
        elif r.kind == "referential":
            parent = r.options["parent"].select(F.col(r.options["parent_column"]).alias(r.column)).distinct().withColumn("_hit", F.lit(True))
            hit = df.join(parent, r.column, "left")
            bad = F.col(r.column).isNotNull() & F.col("_hit").isNull()
            parts.append(result(hit.agg(rows().alias("checked"), count_if(bad).alias("failed")), r.name))
        elif r.kind == "scd2":
            per = scd2_violations(df, r.column)
            parts.append(result(per.agg(rows().alias("checked"), count_if(F.col("_bad")).alias("failed")), r.name))
    return union_all(*parts)


def flag_rows(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Keep every row and add one boolean ``_dq_*`` column per check (NULL counts as no issue)."""
    return df.withColumns({f"_dq_{n}": F.coalesce(c, F.lit(False)) for n, c in flags.items()})


def issue_log(df: DataFrame, table: str, key: Column, checks: Mapping[str, Column]) -> DataFrame:
    """One row per failing row and check, from one scan."""
    cells = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return df.select(F.lit(table).alias("table_name"), key.cast("string").alias("row_key"), F.explode(cells).alias("check_name"))


#: Different keys that one task counts, and checked rows whose issues of one kind go to one file, about.
KEYS_PER_TASK, ROWS_PER_FILE = 500_000, 2_000_000


def dealt_issues(log: DataFrame, checked: int, kinds: int) -> DataFrame:
    """An ``issue_log`` of ``checked`` rows and ``kinds`` checks, dealt for a write by ``check_name``.

    Issues of one check go to as many tasks as the checked rows ask for, so what a task sorts before it
    writes stays the same however many rows there are.
    """
    files = max(1, -(-checked // ROWS_PER_FILE))
    tasks = max(int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")), files * kinds)
    return log.repartition(tasks, "check_name", F.pmod(F.monotonically_increasing_id(), F.lit(files)))


def issue_counts(log: DataFrame) -> DataFrame:
    """Issues and different rows with them per table and check, from a stored ``issue_log``.

    The log is dealt by (table, check, key) into tasks of limited size before keys are compared, so the memory of a task
    does not follow the size of the files.
    """
    tasks = max(int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-log.count() // KEYS_PER_TASK))
    dealt = log.select("table_name", "check_name", "row_key").repartition(tasks, "table_name", "check_name", "row_key")
    per_key = dealt.groupBy("table_name", "check_name", "row_key").agg(rows().alias("_n"))
    return per_key.groupBy("table_name", "check_name").agg(F.sum("_n").alias("n"), F.count("row_key").alias("keys"))


def split_quarantine(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the joined reasons)."""
    reason = F.concat_ws("; ", *[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in reasons.items()])
    marked = df.withColumn("reject_reason", reason)
    return marked.where(F.col("reject_reason") == "").drop("reject_reason"), marked.where(F.col("reject_reason") != "")
