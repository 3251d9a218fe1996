"""Ordered operations that stay distributed when one group holds most of the rows.

A SQL window sends a whole partition to one task. The functions here first count the
largest group. While it is small they return the plain window plan (one shuffle). Beyond
``fleetlake.hotGroupRows`` rows the frame is dealt by ranges of (group, order), as a sort
would be: a large group spans many ranges, each is scanned by its own task, and a table of
range totals supplies what came before it. The limit does not grow with the data, and the
number of ranges follows the number of rows. Results are the same on both paths; no row is
dropped. Any column type that sorts can be a key or an order column.

``order`` is a list of column names, ``-name`` meaning descending; NULLs sort last. The
last one must make the order unique within a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fleetlake.session import materialise

DEFAULT_HOT_ROWS = 2_000_000


def hot_rows_limit(df: DataFrame) -> int:
    """Rows one task may sort for a single group."""
    return int(df.sparkSession.conf.get("fleetlake.hotGroupRows", str(DEFAULT_HOT_ROWS)))


def same_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as group keys do."""
    renamed = right.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_j_{k}" for k in keys])


def order_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_last() for o in order]


def _spec(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order_columns(order))


def _name(o: str) -> str:
    return o.removeprefix("-")


class Split:
    """Whether groups of a frame must be cut for ordered work; measured once, used by several steps.

    ``small`` is True when no group exceeds ``hot_rows``: a plain window is then safe, and only
    a count of the rows may have run. A larger frame is written once to the shared
    folder, so neither the measurement nor the steps that follow compute its input again.
    Frames passed to ``mark`` must hold the same rows per group as the measured one
    (columns may have been added).
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None, force: bool = False):
        """``force`` cuts groups of any size, into at least as many ranges as there are shuffle partitions."""
        self.keys, self.order = list(keys), list(order)
        self.hot_rows = hot_rows or hot_rows_limit(df)
        self._measured, self._stored = df, df
        self._least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if force else 1
        self.total = df.count()  # partial counts per task; a LIMIT would gather its rows in one
        self.small = self.total <= self.hot_rows and not force
        if self.small:
            return
        self._stored = materialise(df, "ordered")
        if keys:
            counts = self._stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            seen = counts.agg(F.max("_n").alias("top"), F.sum("_n").alias("total")).first()
            self.total, self.small = seen["total"] or 0, (seen["top"] or 0) <= self.hot_rows and not force
        else:
            self.total = self._stored.count()

    def of(self, df: DataFrame) -> DataFrame:
        """The stored copy of the measured frame; any other frame itself."""
        return self._stored if df is self._measured else df

    def mark(self, df: DataFrame) -> DataFrame:
        """Add ``_r``: the number of the range of (group, order) a row lies in; written once, as several steps read it."""
        ranges = max(self._least, -(-2 * self.total // self.hot_rows))
        dealt = self.of(df).repartitionByRange(ranges, *[F.col(k).asc_nulls_last() for k in self.keys], *order_columns(self.order))
        return materialise(dealt.withColumn("_r", F.spark_partition_id()), "ranges")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    hot_rows: int | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Running sums (current row included) per group; sum ``lit(1)`` for a row number."""
    split = split or Split(df, keys, order, hot_rows)
    if split.small:
        w = _spec(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return split.of(df).withColumns({name: F.sum(c).over(w) for name, c in sums.items()})
    marked = split.mark(df)
    w = _spec([*keys, "_r"], order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumns({name: F.sum(c).over(w) for name, c in sums.items()})
    totals = marked.groupBy(*keys, "_r").agg(*[F.sum(c).alias(f"_t_{name}") for name, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and range, less the first range of each group; joined by size, without a hint
    known = [F.sum(f"_t_{name}").over(before).alias(f"_o_{name}") for name in sums]
    offsets = totals.select(*keys, "_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_r")).alias("_nth"), *known)
    joined = same_key_join(local, offsets.where("_nth > 1").drop("_nth"), [*keys, "_r"], "left")
    filled = {
        name: F.when(F.col(f"_o_{name}").isNull(), F.col(name)).otherwise(
            F.col(f"_o_{name}") + F.coalesce(F.col(name), F.lit(0))
        )
        for name in sums
    }
    return joined.withColumns(filled).drop("_r", *[f"_o_{name}" for name in sums])


def row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    hot_rows: int | None = None,
    split: Split | None = None,
) -> DataFrame:
    """1-based position in the group."""
    return running(df, keys, order, {name: F.lit(1).cast("bigint")}, hot_rows, split)


def bounded(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    exprs: dict[str, Callable[[WindowSpec], Column]],
    before: int = 1,
    after: int = 0,
    hot_rows: int | None = None,
    split: Split | None = None,
) -> DataFrame:
    """Window expressions that look at most ``before`` rows back and ``after`` ahead.

    Each expression gets the ordered window and adds its own ROWS frame, lag or lead.
    Hot groups are cut into chunks of consecutive rows; the few neighbouring rows a
    chunk needs are copied into it and dropped again afterwards.
    """
    split = split or Split(df, keys, order, hot_rows)
    if split.small:
        w = _spec(keys, order)
        return split.of(df).withColumns({name: f(w) for name, f in exprs.items()})
    size = max(split.hot_rows, before + after + 1)
    numbered = row_number(df, keys, order, "_rn", split=split)
    chunk = F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint")
    pos = (F.col("_rn") - 1) % F.lit(size)
    own = F.struct(chunk.alias("id"), F.lit(True).alias("own"))
    ahead = F.when(pos >= size - before, F.struct((chunk + 1).alias("id"), F.lit(False).alias("own")))
    behind = F.when(
        (pos < after) & (chunk > 0), F.struct((chunk - 1).alias("id"), F.lit(False).alias("own"))
    )
    copies = numbered.withColumn("_c", F.explode(F.array_compact(F.array(own, ahead, behind))))
    w = Window.partitionBy(*keys, F.col("_c.id")).orderBy("_rn")
    out = copies.withColumns({name: f(w) for name, f in exprs.items()})
    return out.where(F.col("_c.own")).drop("_c", "_rn")


def _with_group_size(df: DataFrame, keys: Sequence[str], source: DataFrame, total: int) -> DataFrame:
    if not keys:
        return df.withColumn("_n", F.lit(total).cast("bigint"))
    return same_key_join(df, source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)


def ntile(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiles: dict[str, int], hot_rows: int | None = None
) -> DataFrame:
    """NTILE columns; the first ``n mod k`` tiles hold one row more."""
    split = Split(df, keys, order, hot_rows)
    df = split.of(df)
    if split.small:
        w = _spec(keys, order)
        return df.withColumns({name: F.ntile(k).over(w).cast("bigint") for name, k in tiles.items()})
    numbered = _with_group_size(row_number(df, keys, order, "_rn", split=split), keys, df, split.total)

    def tile(k: int) -> Column:
        q = F.floor(F.col("_n") / F.lit(k))
        r = F.col("_n") % F.lit(k)
        wide = r * (q + 1)
        rn = F.col("_rn")
        return F.when(rn <= wide, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
            r + F.floor((rn - 1 - wide) / F.greatest(q, F.lit(1))) + 1
        )

    return numbered.withColumns({name: tile(k).cast("bigint") for name, k in tiles.items()}).drop("_rn", "_n")


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    rank: str | None = None,
    dense: str | None = None,
    percent: str | None = None,
    cume: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK, PERCENT_RANK and CUME_DIST by one column (``-name`` = descending)."""
    wanted = {"rank": rank, "dense": dense, "percent": percent, "cume": cume}
    wanted = {kind: name for kind, name in wanted.items() if name}
    split = Split(df, keys, [value], hot_rows)
    df = split.of(df)
    if split.small:
        w = _spec(keys, [value])
        native = {
            "rank": lambda: F.rank().over(w).cast("bigint"),
            "dense": lambda: F.dense_rank().over(w).cast("bigint"),
            "percent": lambda: F.percent_rank().over(w),
            "cume": lambda: F.cume_dist().over(w),
        }
        return df.withColumns({name: native[kind]() for kind, name in wanted.items()})
    # one row per distinct value, so ties collapse before anything is ordered
    column = _name(value)
    per_value = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = running(
        per_value, keys, [value], {"_upto": F.col("_ties"), "_dense": F.lit(1).cast("bigint")}, split.hot_rows
    )
    ranked = _with_group_size(ranked, keys, df, split.total)
    position = F.col("_upto") - F.col("_ties") + 1
    made = {
        "rank": position,
        "dense": F.col("_dense"),
        "percent": F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(
            (position - 1).cast("double") / (F.col("_n") - 1).cast("double")
        ),
        "cume": F.col("_upto").cast("double") / F.col("_n").cast("double"),
    }
    table = ranked.select(*keys, column, *[made[kind].alias(name) for kind, name in wanted.items()])
    return same_key_join(df, table, [*keys, column])


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], hot_rows: int | None = None
) -> DataFrame:
    """Exact interpolated percentiles per group.

    Small groups use the built-in aggregate. A hot group is never held in one buffer:
    its distinct values get running counts and only the two neighbours of each
    percentile position are kept.
    """
    data = df.where(F.col(value).isNotNull())
    split = Split(data, keys, [value], hot_rows)
    data = split.of(data)
    if split.small:
        one = df.groupBy(*keys).agg(F.percentile(value, F.lit(list(probs.values()))).alias("_q"))
        return one.select(*keys, *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(probs)])
    per_value = data.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = running(per_value, keys, [value], {"_upto": F.col("_ties")}, split.hot_rows)
    ranked = _with_group_size(ranked, keys, data, split.total)
    first = F.col("_upto") - F.col("_ties")

    def at(position: Column) -> Column:
        inside = (first <= position) & (position < F.col("_upto"))
        return F.max(F.when(inside, F.col(value)))

    parts, finish = [], []
    for name, p in probs.items():
        target = (F.col("_n") - 1).cast("double") * F.lit(p)
        parts += [
            at(F.floor(target)).alias(f"_lo_{name}"),
            at(F.ceil(target)).alias(f"_hi_{name}"),
            F.max(target - F.floor(target)).alias(f"_f_{name}"),
        ]
        lo, hi, frac = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_f_{name}")
        finish.append((lo * (F.lit(1.0) - frac) + hi * frac).alias(name))
    out = ranked.groupBy(*keys).agg(*parts).select(*keys, *finish)
    return same_key_join(df.select(*keys).distinct(), out, keys, "left") if keys else out
