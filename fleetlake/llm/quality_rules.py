"""Quality rules whose limits come from the data: quantile sketches per language and source.

Pass 1 measures every whole text. Pass 2 sketches each rule's measure: values fall into buckets whose
borders grow by a constant factor, so a quantile is known within ``ERROR`` of its value, and two
sketches merge by adding their buckets. Counts are made per language and source and merged upward to
the language and to the whole table. A group's limits are drawn toward those of the level above, as if
``PRIOR`` texts had come from there: a small group follows its parent, a large one itself, without a
size at which the verdict jumps. The limits are joined back to the documents; the join is left to
Spark, which splits hot groups.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import map_texts
from fleetlake.session import materialise

ERROR = 0.01
PRIOR = 200
FENCE = 3.0

# Measures as (name, numerator, denominator, least distance of a limit from the quartiles).
MEASURES = [
    ("mean_word", "word_chars", "n_words", 1.0),
    ("symbols", "n_symbols", "n_words", 0.1),
    ("dup_lines", "n_dup_lines", "n_lines", 0.2),
    ("repeats", "n_repeat_words", "n_words", 0.15),
]
TWO_SIDED = ("mean_word",)
SHARES = ("dup_lines", "repeats")  # never above 1
SYMBOLS = "#*$%&|<>"
WINDOW = 8
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def repeated_words(texts: list[str]) -> tuple[list[int], list[int]]:
    """Words of each text, and how many of them lie in a window of eight words that the text holds twice or more.

    Windows get names by doubling: equal pairs of words, of pairs, of fours. Words are numbered per text.
    """
    ids: list[int] = []
    sizes = []
    for t in texts:
        base, seen = len(ids), {}
        words = t.encode().split()
        ids += [seen.setdefault(w, base + i) for i, w in enumerate(words)]
        sizes.append(len(words))
    out = np.zeros(len(texts), np.int64)
    if len(ids) > WINDOW:
        name = np.array(ids, np.int64)
        for width in (1, 2, 4):
            name = _named(name[:-width], name[width:])
        owner = np.repeat(np.arange(len(texts)), sizes)
        whole = owner[: len(name)] == owner[WINDOW - 1 :]
        count = np.bincount(name[whole], minlength=int(name.max()) + 1)
        starts = np.flatnonzero(whole & (count[name] > 1))
        edge = np.zeros(len(ids) + 1, np.int64)
        edge[starts] += 1
        np.subtract.at(edge, starts + WINDOW, 1)
        out = np.bincount(owner, weights=np.cumsum(edge[:-1]) > 0, minlength=len(texts)).astype(np.int64)
    return sizes, out.tolist()


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those among them that equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines), len(lines) - len(set(lines))


def measure(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Counts per whole text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; NULL as empty."""

    def work(texts: list[str]) -> list[list]:
        words, repeats = repeated_words(texts)
        chars = [len(t) - sum(map(t.count, BLANKS)) for t in texts]
        symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
        lines = [duplicate_lines(t) for t in texts]
        return [words, chars, symbols, [a for a, _ in lines], [b for _, b in lines], repeats]

    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    return map_texts(docs, text, [(n, "long") for n in names], work, keep)


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, bucket, n): bucket 0 holds zero, bucket b the values up to (1+ERROR)/(1-ERROR) to the power b less 10,000."""
    step = math.log((1 + ERROR) / (1 - ERROR))
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), (F.col(a) / F.col(b)).alias("value")) for name, a, b, _ in MEASURES]))
    bucket = F.when(F.col("v.value") > 0, F.ceil(F.log("v.value") / F.lit(step)) + 10_000).otherwise(F.lit(0))
    # empty texts fail the base rules and say nothing about a group
    return measured.where("n_words > 0").select(*groups, values.alias("v")).groupBy(*groups, "v.measure", bucket.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """The sketch of coarser groups: the buckets' counts add up."""
    return sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, docs, low, high): quartiles of a sketch, moved out by ``FENCE`` times their distance.

    The upper limit of a share lies at most half way from the third quartile to 1, so it can always be passed.
    """
    key = [*groups, "measure"]
    step = math.log((1 + ERROR) / (1 - ERROR))
    value = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(F.exp((F.col("bucket") - 10_000) * F.lit(step)) * F.lit(1 - ERROR))
    w = Window.partitionBy(*key)
    upto = sketch.select(*key, value.alias("value"), F.sum("n").over(w.orderBy("bucket")).alias("upto"), F.sum("n").over(w).alias("docs"))
    quartile = lambda p: F.min(F.when(F.col("upto") >= F.col("docs") * F.lit(p), F.col("value")))
    q = upto.groupBy(*key).agg(F.max("docs").alias("docs"), quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    least = F.element_at(F.create_map(*[F.lit(x) for name, _, _, d in MEASURES for x in (name, d)]), F.col("measure"))
    wide = F.greatest(F.lit(FENCE) * (F.col("q3") - F.col("q1")), least)
    low = F.when(F.col("measure").isin(*TWO_SIDED), F.col("q1") - wide).otherwise(F.lit(-1.0))
    high = F.col("q3") + wide
    high = F.when(F.col("measure").isin(*SHARES), F.least(high, (F.col("q3") + 1) / 2)).otherwise(high)
    return q.select(*key, "docs", low.alias("low"), high.alias("high"))


def thresholds(measured: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group: the limits of every measure, each level's drawn toward those of the level above."""
    by_group = sketches(measured, groups)
    levels = [groups[:n] for n in range(len(groups), -1, -1)]
    found = None
    for i, level in enumerate(levels):
        made = limits(by_group if i == 0 else merged(by_group, level), level).withColumnsRenamed({c: f"{c}_{i}" for c in ("docs", "low", "high")} | {c: f"{c}_{i}" for c in level} | {"measure": f"measure_{i}"})
        if found is None:
            found = made
            continue
        same = [F.col(f"{c}_0").eqNullSafe(F.col(f"{c}_{i}")) for c in level] + [F.col("measure_0") == F.col(f"measure_{i}")]
        found = found.join(made, same, "left")
    last = len(levels) - 1

    def pick(c: str):
        out = F.col(f"{c}_{last}")
        for i in range(last - 1, -1, -1):
            out = (F.col(f"docs_{i}") * F.col(f"{c}_{i}") + PRIOR * out) / (F.col(f"docs_{i}") + PRIOR)
        return out

    one = found.select(*[F.col(f"{g}_0").alias(g) for g in groups], F.col("measure_0").alias("measure"), pick("low").alias("low"), pick("high").alias("high"))
    aggs = [F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}") for name, *_ in MEASURES for side in ("low", "high")]
    return one.groupBy(*groups).agg(*aggs)


def quality_rules(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document.

    ``kept`` is false where the fixed rules fail (under 20 words, or more than 30 % repeated words) and
    where a measure lies outside its group's limits. NULL languages and sources are groups of their own;
    a NULL or empty text has no words and is not kept. Repeated rows stay. An empty table gives an
    empty result. Other columns are not read.
    """
    source_cols = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"))
    measured = materialise(measure(source_cols), "quality-rules")
    found = thresholds(measured, ["lang", "source"]).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(found, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    outside = F.lit(False)
    for name, a, b, _ in MEASURES:
        value = F.col(a) / F.when(F.col(b) > 0, F.col(b))
        outside = outside | F.coalesce((value > F.col(f"high_{name}")) | (value < F.col(f"low_{name}")), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~outside).alias("kept"), "lang", "source", "n_lines"
    )
