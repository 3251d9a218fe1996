"""Near-duplicates by SimHash fingerprints and vantage-point trees.

Two fingerprints within ``MAX_BITS`` = 3 of 64 bits differ by at most 1 bit in one of their halves. For
each half a vantage-point tree splits the fingerprints by their distance to chosen fingerprints,
measured on that half. Its upper levels are made on the driver from a bounded sample and send every
fingerprint to its shard, and as a query to every other shard that its ball of radius 1 overlaps: by
the triangle inequality no partner lies elsewhere. Inside a shard the tree goes on down to small
leaves, where all 64 bits decide. Shards return a spanning forest of what they linked, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import map_texts, shielded
from fleetlake.llm.components import components
from fleetlake.session import materialise

WIDTH = 3
MAX_BITS = 3
HALVES = (0x00000000FFFFFFFF, 0xFFFFFFFF00000000)
#: Fingerprints the driver reads to place the upper vantage points.
SAMPLE = 20_000
#: Fingerprints a shard should own; one that owns more is dealt to several tasks.
SHARD = 8_000
LEAF = 256


# --- fingerprints ---


def fingerprint_batch(texts: list[str], width: int) -> list[int]:
    """64-bit majority of the XXH64 (seed 42) of each text's word shingles, as signed numbers."""
    hashes: list[int] = []
    sizes = []
    h = xxhash.xxh64_intdigest
    for text in texts:
        words = text.encode().lower().split()
        joined = b" ".join(words)
        if len(words) <= width:
            made = [h(joined, 42)] if words else []
        else:
            ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
            starts = [0, *[e + 1 for e in ends[:-1]]]
            made = [h(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :])]
        hashes += made
        sizes.append(len(made))
    n = np.array(sizes, np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate([[0], np.cumsum(n[some])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little")
        out[some] = packed.view("<u8").ravel()
    return out.view(np.int64).tolist()


def fingerprints(docs: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",), width: int = WIDTH) -> DataFrame:
    """``keep`` plus ``fingerprint`` (long) of every whole text; a text without words (or NULL) has 0."""
    return map_texts(docs, text, [("fingerprint", "long")], lambda texts: [fingerprint_batch(texts, width)], keep)


# --- vantage-point trees ---


def distance(a: np.ndarray, b, mask: int = 0xFFFFFFFFFFFFFFFF) -> np.ndarray:
    return np.bitwise_count((a ^ b) & np.uint64(mask)).astype(np.int64)


def split_at(values: np.ndarray, mask: int, seed: int) -> tuple[np.uint64, int] | None:
    """A vantage point and the median distance to it; None where no candidate splits the values."""
    rng = np.random.default_rng(seed)
    best = None
    for vantage in values[rng.integers(0, len(values), 6)]:
        d = distance(values, vantage, mask)
        border = int(np.median(d))
        for mu in (border, border - 1):
            inside = int((d <= mu).sum())
            near = int(((d == mu) | (d == mu + 1)).sum())
            if 0 < inside < len(values) and (best is None or abs(2 * inside - len(values)) + near < best[0]):
                best = (abs(2 * inside - len(values)) + near, vantage, mu)
    return best and (best[1], best[2])


def build(values: np.ndarray, mask: int, leaf: float, seed: int = 1) -> tuple | None:
    """Nested (vantage point, radius, inside, outside); None is a shard."""
    if len(values) <= leaf or not (at := split_at(values, mask, seed)):
        return None
    inside = distance(values, at[0], mask) <= at[1]
    return (*at, build(values[inside], mask, leaf, 2 * seed), build(values[~inside], mask, leaf, 2 * seed + 1))


def route(tree: tuple | None, values: np.ndarray, own: np.ndarray, mask: int, reach: int, shard: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, fingerprints, whether the shard owns them) for every shard that a fingerprint's ball overlaps."""
    if not len(values):
        return
    if tree is None:
        yield shard, values, own
        return
    vantage, mu, inside, outside = tree
    d = distance(values, vantage, mask)
    near, far = d - reach <= mu, d + reach > mu
    yield from route(inside, values[near], own[near] & (d[near] <= mu), mask, reach, 2 * shard)
    yield from route(outside, values[far], own[far] & (d[far] > mu), mask, reach, 2 * shard + 1)


class Forest:
    """Links kept only where they join two groups not yet joined."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def tie(self, a: int, b: int) -> int:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[b] = a
            self.links.append((a, b))
        return a


def link_shard(values: np.ndarray, own: np.ndarray, mask: int, reach: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links between the shard's own fingerprints and all that were sent to it."""
    forest = Forest(len(values))
    label = np.arange(len(values))  # a group met earlier; may be out of date, then root() knows

    def compare(members: np.ndarray, queries: np.ndarray) -> None:
        for at in range(0, len(members), 2048):
            block = members[at : at + 2048]
            for q in range(0, len(queries), 512):
                rows = queries[q : q + 512]
                near = np.bitwise_count(values[rows][:, None] ^ values[block][None, :]) <= max_bits
                for i in np.flatnonzero(near.sum(1) > np.isin(rows, block, assume_unique=True)):
                    found = block[near[i]]
                    group = forest.root(int(rows[i]))
                    for other in np.unique(label[found]):
                        group = forest.tie(group, int(other))
                    label[found] = group
                    label[rows[i]] = group

    def descend(members: np.ndarray, queries: np.ndarray, seed: int) -> None:
        if not len(members) or not len(queries):
            return
        at = split_at(values[members], mask, seed) if len(members) > LEAF else None
        if not at:
            compare(members, queries)
            return
        dm, dq = distance(values[members], at[0], mask), distance(values[queries], at[0], mask)
        descend(members[dm <= at[1]], queries[dq - reach <= at[1]], seed + 1)
        descend(members[dm > at[1]], queries[dq + reach > at[1]], seed + 1)

    descend(np.flatnonzero(own), np.arange(len(values)), 1)
    return [(int(values[a]), int(values[b])) for a, b in forest.links]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (column ``fingerprint``) at ``max_bits`` or fewer differing bits."""
    spark = distinct.sparkSession
    reach = max_bits // len(HALVES)
    count = distinct.count()
    sample = [r[0] for r in distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()]
    seen = np.array(sample, np.int64).view(np.uint64)
    # a leaf of the upper tree holds SHARD fingerprints, or so many as 64 sampled ones stand for
    leaf = max(64.0, SHARD * len(seen) / max(count, 1))
    trees = [build(seen, mask, leaf) for mask in HALVES]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for half, (tree, mask) in enumerate(zip(trees, HALVES)):
                for shard, found, own in route(tree, values, np.ones(len(values), bool), mask, reach):
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, half, np.int32)), pa.array(np.full(n, shard, np.int64)), pa.array(found.view(np.int64)), pa.array(own)], names=["half", "shard", "fingerprint", "own"]
                    )

    sent = materialise(distinct.select("fingerprint").mapInArrow(send, "half int, shard long, fingerprint long, own boolean"), "simhash-shards")
    # a shard that owns too much is dealt to several tasks; each gets all queries and a part of what is owned
    parts = sent.where("own").groupBy("half", "shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(4 * SHARD)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    dealt = sent.join(parts, ["half", "shard"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("half", "shard", "part", "fingerprint", (F.col("own") & (mine == F.col("part"))).alias("own"))

    def link(key: tuple, group: pa.Table) -> pa.Table:
        values = group.column("fingerprint").to_numpy().view(np.uint64)
        found = link_shard(values, group.column("own").to_numpy(), HALVES[key[0].as_py()], reach, max_bits)
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return dealt.groupBy("half", "shard", "part").applyInArrow(link, "a long, b long")


def classes(made: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fingerprint, root): the component of every distinct fingerprint of ``made``."""
    distinct = materialise(made.select("fingerprint").distinct(), "simhash-distinct")
    found = components(links(distinct, max_bits)).withColumnRenamed("node", "fingerprint")
    return distinct.join(found, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def simhash_components(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every document.

    Links hold between fingerprints at ``max_bits`` or fewer differing bits. A text without words, or
    NULL, has fingerprint zero and is linked like any other. NULL ids never name a component that has
    another id; a component of NULL ids only has NULL. Repeated rows stay. An empty table gives an
    empty result. Other columns are not read.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    made = materialise(fingerprints(own, width=width), "simhash-fingerprints")
    roots = materialise(classes(made, max_bits), "simhash-classes")
    least = made.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(roots, "fingerprint")
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = roots.join(named, "root").select("fingerprint", "component_id")
    joined = made.join(by_print, "fingerprint")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, one for each component: the one with the smallest id (NULL last), then the smallest text hash.

    Same columns as ``docs``. Of rows equal in id and text one stays.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("_hash"))
    made = materialise(fingerprints(own, keep=("doc_id", "_hash"), width=width), "simhash-fingerprints")
    roots = classes(made, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"))).alias("first")
    # one row per fingerprint before the join, one per component after it
    per_print = made.groupBy("fingerprint").agg(first).join(roots, "fingerprint")
    chosen = materialise(per_print.groupBy("root").agg(F.min("first").alias("first")).select("first._id", "first._h"), "simhash-chosen")
    plain, named, back = shielded(docs)

    def key(of: Column, hashed: Column) -> Column:
        return F.concat_ws(":", of.isNull().cast("string"), of.cast("string"), hashed.cast("string"))

    # texts are shuffled once, by the key that the window and the join share; copies go before it
    marked = plain.withColumn("key", key(F.col(named[doc_id]), F.xxhash64(F.col(named[text]))))
    one = Window.partitionBy("key").orderBy("key")
    single = marked.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return back(single.join(chosen.select(key(F.col("_id"), F.col("_h")).alias("key")), "key", "left_semi"))
