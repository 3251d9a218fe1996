"""Mixing sources to target weights along a curriculum that changes over time.

Each source's share of all words follows its weight; a source gives at most ``MOST`` times its words
and what it cannot give goes to the others by weight. Its weight also moves over training time on a
linear schedule. The integral of that schedule is the cumulative demand for its words; inverting it
turns the place a document has in its source's supply into a training position, and documents are
range-sorted by position. Supply is a fixed pseudo-random order, read as often as the target asks.

Only DataFrame functions. The order is that of an MD5 of id and text. Running sums over a source are made in two
steps, over 4,096 ranges of it and inside each, so no task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
#: (weight at the start, weight at the end) of training, relative to the source's mean; dealt to the sources in turn.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
RANGE_DIGITS = 3  # hexadecimal
WORD = r"[^\x20\x09-\x0D]+"


def turn(values: Sequence, rank: Column) -> Column:
    """The value whose turn it is at a 1-based rank."""
    return F.get(F.array(*[F.lit(v) for v in values]), ((rank - 1) % len(values)).cast("int"))


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size): one row per source.

    Sources stand in code-point order, NULL last. They are filled from the one whose limit is reached
    first: as soon as one source's share of what is left stays within its limit, so do all after it.
    """
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", turn(weights, F.col("rank")))
    limit = (F.col("source_size") * most).cast("double")
    before = Window.orderBy(limit / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("limit", limit).withColumn("level", left / weight_left)
    fits = F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.struct((F.col("limit") / F.col("weight")).alias("a"), "rank", "level"))
    final = F.min(fits).over(every)["level"]
    return level.withColumn("final", final).select("source", "source_size", "rank", F.least(F.col("limit"), F.col("final") * F.col("weight")).alias("target"))


def position(used: Column, start: Column, end: Column) -> Column:
    """Training time (0 to 1) at which a linear schedule has used up a share of the demand."""
    curved = (F.sqrt(start * start + (end * end - start * start) * used) - start) / F.when(end != start, end - start)
    return F.when(end == start, used).otherwise(curved)


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    keep: Sequence[str] = (),
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    most: int = MOST,
) -> DataFrame:
    """Every document with what the mix takes of it, sorted by training position.

    Columns: doc_id, source, size (words; NULL text 0), source_size, target (words its source gives),
    taken (words taken of this document, repeats counted; the last document of a source may be cut),
    positions (one per reading), position (the first; NULL where nothing is taken), and ``keep``.
    A NULL source is a source of its own, sorted last; NULL ids and repeated rows are documents like
    others. Equal rows are interchangeable, so reruns agree. An empty table gives an empty result.
    Other columns are not read; a kept column must not be named like a result.
    """
    ident = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    words = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), words.alias("size"), F.md5(ident.cast("binary")).alias("_h"), *[F.col(f"`{c}`") for c in keep])
    own = own.withColumn("_range", F.substring("_h", 1, RANGE_DIGITS))
    ranges = materialise(own.groupBy("source", "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    totals = ranges.groupBy("source").agg(F.sum("_words").alias("source_size"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source", "_range", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"))
    targets = source_targets(totals, weights, most).withColumnRenamed("source", "_t")
    plan = offsets.join(targets, F.col("source").eqNullSafe(F.col("_t"))).drop("_t").withColumnsRenamed({"source": "_s", "_range": "_r"})
    inside = Window.partitionBy("source", "_range").orderBy("_h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    before = F.col("_offset") + F.col("_inside")
    total = F.col("source_size")
    rounds = F.when(total > 0, F.floor(F.col("target") / total)).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target") - rounds * total).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before)).cast("long")
    start, end = turn([s for s, _ in schedules], F.col("rank")), turn([e for _, e in schedules], F.col("rank"))
    step = joined.withColumns({"_before": before, "_rounds": rounds, "_part": part, "_start": start, "_end": end})

    def reading(k: Column) -> Column:
        read = F.when(k < F.col("_rounds"), F.col("size")).otherwise(F.col("_part"))
        used = (k * F.col("source_size") + F.col("_before") + read / 2) / F.col("target")
        return F.when(read > 0, position(F.least(used, F.lit(1.0)), F.col("_start"), F.col("_end")))

    positions = F.array_compact(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_rounds")), reading))
    out = step.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("_rounds") * F.col("size") + F.col("_part")).alias("taken"), positions.alias("positions"), *[F.col(f"`{c}`") for c in keep]
    )
    return out.withColumn("position", F.get("positions", F.lit(0))).orderBy(F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last())


def readings(mixed: DataFrame) -> DataFrame:
    """The result of ``mix`` with one row per reading of a document, in training order.

    In place of ``positions``: reading (from 0), position (of this reading) and words (read this time; the last
    reading may be cut). ``words`` adds up to ``taken``; documents that are not read have no row.
    """
    rest = [c for c in mixed.columns if c not in ("positions", "position")]
    placed = mixed.select(*[F.col(f"`{c}`") for c in rest], F.posexplode("positions").alias("reading", "position"))
    placed = placed.withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("reading") * F.col("size")))
    return placed.orderBy("position", F.col("doc_id").asc_nulls_last(), "reading")


def oracle_sql(table: str = "documents") -> str:
    """The same figures in DuckDB SQL, with the default weights and schedules; position is that of the first reading."""
    pick = lambda values: "CASE (rnk - 1) % " + str(len(values)) + "".join(f" WHEN {i} THEN {v}::DOUBLE" for i, v in enumerate(values)) + " END"
    return f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
            md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || COALESCE(text, '')) AS h FROM {table}),
        s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) AS rnk FROM s),
        w AS (SELECT *, {pick(WEIGHTS)} AS weight, CAST(source_size * {MOST} AS DOUBLE) AS lim FROM r),
        l AS (SELECT *, (SUM(CAST(source_size AS DOUBLE)) OVER () - COALESCE(SUM(lim) OVER f, 0)) / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER f, 0)) AS level FROM w
            WINDOW f AS (ORDER BY lim / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, rnk, LEAST(lim, (SELECT level FROM l WHERE lim / weight >= level ORDER BY lim / weight, rnk LIMIT 1) * weight) AS target FROM l),
        b AS (SELECT d.*, CAST(COALESCE(SUM(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d),
        j AS (SELECT b.*, source_size, rnk, target, CASE WHEN source_size > 0 THEN CAST(FLOOR(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source),
        p AS (SELECT *, CAST(GREATEST(0, LEAST(size, CAST(FLOOR(target - rounds * source_size) AS BIGINT) - before)) AS BIGINT) AS part, {pick([a for a, _ in SCHEDULES])} AS a, {pick([e for _, e in SCHEDULES])} AS e FROM j),
        u AS (SELECT *, rounds * size + part AS taken, LEAST((before + CAST(CASE WHEN rounds > 0 THEN size ELSE part END AS DOUBLE) / 2) / target, 1.0::DOUBLE) AS used FROM p)
        SELECT doc_id, source, size, source_size, target, taken,
            CASE WHEN CASE WHEN rounds > 0 THEN size ELSE part END > 0 THEN CASE WHEN a = e THEN used ELSE (SQRT(a * a + (e * e - a * a) * used) - a) / (e - a) END END AS position FROM u"""
