"""Ranked lexical search by pipelined term partitioning.

One pass over the documents keeps the terms that any item asks for. Documents are dealt into shards of
``SHARD`` in the order they are read, so no key can make a shard large. The terms are owned by stages,
by weight: rare terms first. In each shard the items go through the stages as bundles: a bundle
holds a sparse set of document accumulators, meets the postings of the stage's terms by cogroup, adds
their integer contributions and travels on. After the last stage each shard gives its best documents and
the best of all shards are the answer.

A contribution is below ``weight * 10**6``, so a bundle knows the most that its later stages can add. Where that is
less than what its ``top``-th document has already, documents that cannot reach it any more leave the bundle and no
others may enter (it is closed). Nothing else is left out: the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import materialise

SHARD = 4096  # documents
ITEMS = 2_000  # items that travel together through a shard
TERMS = 2_000_000  # terms of items in one pass
#: A stage owns the terms whose weight is at least this (and less than the one before): in 1, 5, 22 % of the documents, and the rest.
STAGES = (4600, 3000, 1500, 1)
TOP = 10
# one byte of UTF-8: A-Z lower-cased, ASCII that is neither letter nor digit becomes a blank
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and everything beyond ASCII, only A-Z in lower case."""
    return text.encode().translate(_TERM).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def gains(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Contributions of postings: weights, occurrences and the document's number of terms."""
    m = 100 - 90 + (90 * n * documents) // terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def postings(docs: DataFrame, text: str, doc_id: str, codes, shard: int) -> DataFrame:
    """(shard, slot, doc_id, n, codes, tf) of every document with a term; codes of the items' terms only."""
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    names = ["shard", "slot", "doc_id", "n", "codes", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, at, first = codes.value, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            keep, n, lists, counts = [], [], [], []
            for i, t in enumerate(batch.column(1)):
                words = terms_of(t.as_py())
                if words:
                    found = [(code[w], c) for w, c in Counter(words).items() if w in code]
                    keep.append(i)
                    n.append(len(words))
                    lists.append([c for c, _ in found])
                    counts.append([c for _, c in found])
            place = np.arange(at, at + len(keep))
            at += len(keep)
            columns = [pa.array(first + place // shard), pa.array(place % shard, pa.int32()), batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, f"shard long, slot int, doc_id {kind}, n long, codes array<int>, tf array<bigint>")


def document_counts(found: DataFrame, terms: int) -> np.ndarray:
    """The number of documents that hold each term; tasks count before the sums are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "df"])

    df = np.zeros(terms, np.int64)
    for r in found.select("codes").mapInArrow(run, "code long, df long").groupBy("code").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["code"]] = r["df"]
    return df


class Plan:
    """What every task needs to know: weights, the stage that owns each term, the terms of each item by stage."""

    def __init__(self, items: list[tuple[int, list[int]]], df: np.ndarray, documents: int, terms: int, top: int, shard: int):
        self.documents, self.terms, self.top, self.shard = documents, terms, top, shard
        self.weights = np.array([weight(documents, int(d)) for d in df], np.int64)
        # owner of a term; terms of weight 0 are in nearly every document and add nothing
        self.owner = np.select([self.weights >= s for s in STAGES], range(len(STAGES)), len(STAGES))
        self.items = {}
        for key, codes in items:
            codes = np.array(codes, np.int64)
            parts = [codes[self.owner[codes] == s] for s in range(len(STAGES))]
            self.items[key] = (parts, [1_000_000 * int(self.weights[np.concatenate(parts[s + 1 :])].sum()) if s + 1 < len(parts) else 0 for s in range(len(STAGES))])


class Owner:
    """The postings of one stage's terms in one shard."""

    def __init__(self, slots: np.ndarray, lists: pa.ListArray, amounts: pa.ListArray):
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        codes = lists.flatten().to_numpy()
        order = np.argsort(codes, kind="stable")
        self.codes, self.slots, self.amounts = codes[order], np.repeat(slots, counts)[order], amounts.flatten().to_numpy()[order]

    def add(self, scores: np.ndarray, codes: np.ndarray) -> None:
        """Add the contributions of terms; a document stands once in the postings of a term."""
        for a, b in zip(np.searchsorted(self.codes, codes).tolist(), np.searchsorted(self.codes, codes, "right").tolist()):
            scores[self.slots[a:b]] += self.amounts[a:b]


def through(plan: Plan, stage: int, owner: Owner, key: int, scores: np.ndarray, listed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, bool]:
    """One item's bundle through one stage: (slots, scores, open). ``listed``: slots of a closed bundle."""
    parts, later = plan.items[key]
    owner.add(scores, parts[stage])
    slots = np.flatnonzero(scores) if listed is None else listed
    if len(slots) >= plan.top:
        own = scores[slots]
        least = int(np.partition(own, len(own) - plan.top)[len(own) - plan.top])
        if later[stage] < least:
            slots = slots[own + later[stage] >= least]
            return slots, scores[slots], False
    return slots, scores[slots], listed is None


_BUNDLE = "shard long, part int, item long, slots array<int>, scores array<bigint>, open boolean"


def travel(plan_of, stage: int, own: DataFrame, bundles: DataFrame | None, kind: str, parts: int) -> DataFrame:
    """All bundles through one stage: the next bundles, or after the last stage (item, doc_id, score) of the best of each shard."""
    last = stage + 1 == len(STAGES)
    schema = f"item long, doc_id {kind}, score long" if last else _BUNDLE

    def best(plan: Plan, ids: pa.Array, slots: np.ndarray, scores: np.ndarray, index: dict) -> list[tuple]:
        keep = np.flatnonzero(scores > 0)
        if len(keep) > plan.top:
            own = scores[keep]
            keep = keep[own >= np.partition(own, len(own) - plan.top)[len(own) - plan.top]]
        rows = [(int(scores[i]), ids[index[int(slots[i])]].as_py()) for i in keep]
        rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1]) if r[1] is not None else (-r[0], False))
        return rows[: plan.top]

    def run(key, table: pa.Table, carried: pa.Table | None) -> pa.Table:
        plan = plan_of.value
        shard, part = key[0].as_py(), key[1].as_py()
        table, columns = table.combine_chunks(), []
        slot = table["slot"].to_numpy()
        owner = Owner(slot, *(table[c].chunk(0) if table.num_rows else pa.array([], table.schema.field(c).type) for c in ("codes", "amounts")))
        given = {}
        if carried is not None:
            carried = carried.combine_chunks()
            for i, item in enumerate(carried["item"].to_pylist()):
                given[item] = (carried["slots"][i].values.to_numpy(), carried["scores"][i].values.to_numpy(), carried["open"][i].as_py())
        index = {s: i for i, s in enumerate(slot.tolist())} if last else {}
        columns = [[] for _ in range(3 if last else 6)]
        for item in sorted(plan.items) if carried is None else given:
            if carried is None and item % parts != part:
                continue
            scores, listed = np.zeros(plan.shard, np.int64), None
            if item in given:
                slots, held, open_ = given[item]
                scores[slots] = held
                listed = None if open_ else slots
            slots, held, open_ = through(plan, stage, owner, item, scores, listed)
            if last:
                for score, doc in best(plan, table["doc_id"], slots, held, index):
                    for column, value in zip(columns, (item, doc, score)):
                        column.append(value)
            else:
                for column, value in zip(columns, (shard, part, item, slots.astype(np.int32), held, open_)):
                    column.append(value)
        if last:
            types = [pa.int64(), table.schema.field("doc_id").type, pa.int64()]
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["item", "doc_id", "score"])
        types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.bool_()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["shard", "part", "item", "slots", "scores", "open"])

    grouped = own.groupBy("shard", "part")
    if bundles is None:
        return grouped.applyInArrow(lambda key, table: run(key, table, None), schema)
    return grouped.cogroup(bundles.groupBy("shard", "part")).applyInArrow(run, schema)


def owned(found: DataFrame, plan_of, stage: int, parts: int) -> DataFrame:
    """(shard, part, slot, doc_id, codes, amounts): what the stage's terms contribute to each document, for every part of the items."""
    kind = found.schema["doc_id"].dataType.simpleString()
    names = ["shard", "slot", "doc_id", "codes", "amounts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_of.value
        for batch in batches:
            lists = batch.column(4)
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            codes, tf = lists.flatten().to_numpy(), batch.column(5).flatten().to_numpy()
            row = np.repeat(np.arange(len(counts)), counts)
            mine = plan.owner[codes] == stage
            codes, tf, row = codes[mine], tf[mine], row[mine]
            made = gains(plan.weights[codes], tf, batch.column(3).to_numpy()[row], plan.documents, plan.terms)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(counts)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(ends, pa.array(codes, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(made, pa.int64()))], names=names)

    out = found.mapInArrow(run, f"shard long, slot int, doc_id {kind}, codes array<int>, amounts array<bigint>")
    if parts > 1:
        return out.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return out.withColumn("part", F.lit(0))


def _search(docs: DataFrame, asked: list[tuple[int, list[bytes]]], text: str, doc_id: str, top: int, shard: int, per_part: int) -> DataFrame | None:
    """(item, doc_id, score) of the best documents of each shard for the items (key, terms) of one pass; None without documents or terms."""
    context = docs.sparkSession.sparkContext
    code = {t: i for i, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
    found = materialise(postings(docs, text, doc_id, context.broadcast(code), shard), "search-postings")
    total = found.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    if not code or not total["n"]:
        return None
    df = document_counts(found, len(code))
    plan = Plan([(k, [code[t] for t in terms]) for k, terms in asked], df, total["n"], total["terms"], top, shard)
    shared, kind = context.broadcast(plan), found.schema["doc_id"].dataType.simpleString()
    parts = -(-len(asked) // per_part)
    bundles = None
    for stage in range(len(STAGES)):
        bundles = travel(shared, stage, owned(found, shared, stage, parts), bundles, kind, parts)
    return bundles


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    top: int = TOP,
    shard: int = SHARD,
    per_part: int = ITEMS,
    most_terms: int = TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` its ``top`` documents with a score above 0.

    Equal scores rank by ascending doc_id (NULL first). NULL texts have no terms; a document without a term does not
    count, an item without one has no result. Every row is a document or an item of its own, repeated rows and ids
    included. Empty tables give an empty result. Other columns are not read. The terms of the items are
    sent to all tasks, about ``most_terms`` at a time: items beyond that take another pass over the documents.
    """
    kind, own = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    spark = docs.sparkSession

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sorted(set(terms_of(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.binary()))], names=["item_id", "terms"])

    source = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    asked = source.mapInArrow(split, f"item_id {own}, terms array<binary>").withColumn("item", F.monotonically_increasing_id())
    asked = materialise(asked, "search-items")
    passes = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // most_terms))
    best = spark.createDataFrame([], f"item long, doc_id {kind}, score long")
    for i in range(passes):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i).select("item", "terms")
        found = _search(docs, [(r["item"], [bytes(t) for t in r["terms"]]) for r in mine.toLocalIterator()], text, doc_id, top, shard, per_part)
        if found is not None:
            best = found if passes == 1 else best.union(materialise(found, "search-best"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def oracle_sql(documents: str = "documents", benchmark: str = "benchmark", top: int = TOP) -> str:
    """The same in DuckDB SQL, over the postings of all terms."""
    runs = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""WITH d AS MATERIALIZED (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM (SELECT ROW_NUMBER() OVER () AS rid, doc_id, {runs} AS terms FROM {documents}) WHERE len(terms) > 0),
        s AS (SELECT COUNT(*) AS N0, CAST(SUM(n) AS BIGINT) AS L0 FROM d),
        q AS MATERIALIZED (SELECT DISTINCT iid, item_id, term FROM (SELECT iid, item_id, UNNEST(terms) AS term FROM (SELECT ROW_NUMBER() OVER () AS iid, item_id, {runs} AS terms FROM {benchmark}))),
        p AS MATERIALIZED (SELECT rid, term, COUNT(*) AS tf FROM (SELECT rid, UNNEST(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * N0 + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, COUNT(*) AS df FROM p GROUP BY term), s),
        g AS MATERIALIZED (SELECT rid, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * N0) // L0)))) AS gain FROM p JOIN d USING (rid) JOIN w USING (term), s),
        a AS (SELECT iid, item_id, rid, SUM(gain) AS score FROM q JOIN g USING (term) GROUP BY iid, item_id, rid HAVING SUM(gain) > 0),
        r AS (SELECT item_id, ROW_NUMBER() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM a JOIN d USING (rid))
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {top}"""
