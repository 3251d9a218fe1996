"""Benchmark items that occur in documents, whole or with edits.

Texts are normalised (words, single blanks, A-Z in lower case, UTF-8 bytes). A window begins at every
word, and at every character where words tell little: in scripts of three bytes a character, which
mostly have no blanks, and in runs of over ``RUN`` bytes. It is as long as the item it is held against. The CGK embedding walks through a window: at step
j it writes the byte it stands on and moves on if a random bit for (j, byte) says so. Edits then cost
few differing places. A walk has ``STEPS`` steps, about half as many bytes, and samples places in them;
a window whose samples equal those of an item is a candidate. An item is entered from every such place from
which a full walk fits, so the walks together cover it, and edits at one place do not hide it. Walks are
repeated with other random bits until copies of the items, edited as far as the similarity allows, are
found at the stated ``recall``.
A walk stops as soon as the samples so far agree with no item; what is left is compared exactly:
edit distance of the item to the best place in the window's surroundings, at most a fifth of its length.

Items are taken in blocks of bounded size, and every block meets all documents.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import map_texts, shielded

SIMILARITY = 0.8
RECALL = 0.9  # of copies with as many random edits as the similarity allows
REPEATS = 32  # at most
STEPS = 64
SAMPLES = 10
ITEMS = 1_000
#: Bytes of the longest run without blanks that is taken for one word.
RUN = 32
#: Steps looked up at once, from the bytes at a window's start; a third only while its table of bytes stays small.
HEAD, HEAD_BYTES = 3, 64
#: Samples after which a walk asks whether any item agrees so far.
ASKED = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def distance_within(item: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``item`` to a part of ``text``, end of that part), by bit-parallel columns."""
    m = len(item)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(text, 1):
        eq = where.get(c, 0)
        x = eq | down
        d0 = (((x & up) + up) ^ up) | x
        rise, fall = down | (full & ~(d0 | up)), up & d0
        score += 1 if rise & top else -1 if fall & top else 0
        if score < best:
            best, end = score, i
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | (full & ~(d0 | rise)), rise & d0
    return best, end


def _walks() -> tuple[np.ndarray, list[list[int]]]:
    """Random bits (repeat, step, byte) and the sampled steps of each repeat: the first three, then one from each part of the walk."""
    rng = np.random.default_rng(2024)
    bits = rng.integers(0, 2, (REPEATS, STEPS, 256)).astype(np.int64)
    even = (STEPS - 1) * np.arange(1, SAMPLES) / (SAMPLES - 1)
    places = [sorted({0, 1, 2, *np.round(even * rng.uniform(0.85, 1.0, SAMPLES - 1)).astype(int).tolist()}) for _ in range(REPEATS)]
    return bits, places


BITS, PLACES = _walks()


def mixed(key: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return (key ^ byte.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)


def slot(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def walked(left: int) -> int:
    """Steps of a walk that cannot leave ``left`` bytes: a power of two."""
    return min(STEPS, 1 << (left.bit_length() - 1)) if left > 0 else 0


def window_starts(x: np.ndarray) -> np.ndarray:
    """Places at which windows begin in texts divided by line feeds: words, and the characters of scripts and runs without blanks."""
    begins = np.concatenate([[0], np.flatnonzero((x == 32) | (x == 10)) + 1])
    sizes = np.diff(np.append(begins, len(x) + 1)) - 1
    long, wide = np.flatnonzero(sizes > RUN), x.max(initial=0) >= 0xE0
    if not len(long) and not wide:
        return begins
    found = np.zeros(len(x) + 1, bool)
    found[begins] = True
    if wide:
        found[:-1] |= x >= 0xE0
    for b, n in zip(begins[long], sizes[long]):
        found[b : b + n] |= (x[b : b + n] & 0xC0) != 0x80
    return np.flatnonzero(found)


def entries(item: bytes) -> list[int]:
    """Offsets from which an item is entered: all places of windows from which a full walk fits."""
    return [s for s in window_starts(np.frombuffer(item, np.uint8)).tolist() if walked(len(item) - s) == walked(len(item))]


@dataclass
class Index:
    """Sampled keys of a block of items."""

    items: list[tuple[int, str]]  # (id, normalised text)
    repeats: Sequence[int]  # the walks taken
    bits: int = 16  # of a table's addresses
    tables: list[dict[int, np.ndarray]] = field(default_factory=list)  # per repeat: step -> keys seen up to that sample
    finals: list[dict[int, dict[int, list[tuple[int, int]]]]] = field(default_factory=list)  # per repeat: steps walked -> key -> (item, offset)
    wanted: list[dict[int, np.ndarray]] = field(default_factory=list)  # the keys of ``finals``, sorted
    heads: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # per repeat, by code of the first bytes: goes on, key, bytes moved

    def __post_init__(self):
        texts = [t.encode() for _, t in self.items]
        places = [(i, o) for i, t in enumerate(texts) for o in entries(t) if t]
        self.bits = max(16, (32 * len(places)).bit_length())
        buffer = np.frombuffer(b"".join(t + bytes(STEPS) for t in texts) or bytes(STEPS), np.uint8)
        begins = np.cumsum([0, *[len(t) + STEPS for t in texts]])
        starts = np.array([begins[i] + o for i, o in places], np.int64)
        # a short item is walked only so far that the walk cannot leave it
        reach = np.array([walked(len(texts[i]) - o) for i, o in places], np.int64)
        for r in self.repeats:
            tables: dict[int, np.ndarray] = {}
            finals: dict[int, dict[int, list[tuple[int, int]]]] = {}
            at, key = starts.copy(), np.zeros(len(starts), np.uint64)
            for j in range(STEPS + 1):
                for k in np.flatnonzero(reach == j) if j else []:
                    finals.setdefault(j, {}).setdefault(int(key[k]), []).append(places[k])
                if j == STEPS or not len(at):
                    break
                byte = buffer[at]
                if j in PLACES[r]:
                    key = mixed(key, byte)
                    if len(tables) < ASKED:
                        tables[j] = np.zeros(1 << self.bits, bool)
                        tables[j][slot(key[reach > j], self.bits)] = True
                at = at + BITS[r, j][byte]
            self.tables.append(tables)
            self.finals.append(finals)
            self.wanted.append({j: np.sort(np.fromiter(keys, np.uint64, len(keys))) for j, keys in finals.items()})
        own = np.unique(np.frombuffer(b"".join(texts), np.uint8))
        own = np.concatenate([[10], own]).astype(np.uint8)  # a line feed stands for every byte that no item holds
        self.classes = np.zeros(256, np.int16)
        self.classes[own[1:]] = np.arange(1, len(own))
        self.head = (HEAD if len(own) <= HEAD_BYTES else HEAD - 1) if len(reach) and reach.min() > HEAD else 0
        self.heads = [self.first_steps(own, r, tables) for r, tables in zip(self.repeats, self.tables)]

    def first_steps(self, own: np.ndarray, r: int, tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the first ``head`` steps of a walk come to, for every combination of as many bytes."""
        codes = np.arange(len(own) ** self.head)
        begin = np.stack([own[codes // len(own) ** k % len(own)] for k in range(self.head - 1, -1, -1)]) if self.head else None
        goes_on, key, moved = np.ones(len(codes), bool), np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.int64)
        for j in range(self.head):
            byte = begin[moved, codes]
            key = mixed(key, byte)
            goes_on &= tables[j][slot(key, self.bits)] & (byte != 10)
            moved = moved + BITS[r, j][byte]
        return goes_on, key, moved

    def codes(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of the first ``head`` bytes of windows."""
        named = self.classes[x]
        out = np.zeros(len(starts), np.int64)
        for k in range(self.head):
            out = out * (int(self.classes.max()) + 1) + named[starts + k]
        return out

    def candidates(self, x: np.ndarray, starts: np.ndarray) -> set[tuple[int, int, int]]:
        """(item, offset in the item, place in ``x``) of windows whose samples equal an item's in some walk. ``x`` ends in zeros."""
        out: set[tuple[int, int, int]] = set()
        if not self.items:
            return out
        codes = self.codes(x, starts)
        for r, tables, finals, wanted, (goes_on, keys, moved) in zip(self.repeats, self.tables, self.finals, self.wanted, self.heads):
            bits, sampled = BITS[r], PLACES[r]
            left = np.flatnonzero(goes_on[codes])
            first, code = starts[left], codes[left]
            at, key = first + moved[code], keys[code]
            for j in range(self.head, STEPS + 1):
                if j in finals:
                    near = np.minimum(np.searchsorted(wanted[j], key), len(wanted[j]) - 1)
                    for k in np.flatnonzero(wanted[j][near] == key):
                        out.update((item, offset, int(first[k])) for item, offset in finals[j][int(key[k])])
                if j == STEPS or not len(at):
                    break
                byte = x[at]
                if j in sampled:
                    key = mixed(key, byte)
                if j in tables:
                    left = tables[j][slot(key, self.bits)]
                    at, first, key, byte = at[left], first[left], key[left], byte[left]
                at = at + bits[j][byte]
        return out

    def matches(self, texts: Sequence[str], similarity: float) -> list[dict[int, tuple[int, int, int]]]:
        """For each text: item id -> (distance, first word, last word) of its best place."""
        norm = [normalised(t) for t in texts]
        x = np.frombuffer(b"\n".join(norm) + b"\n" + bytes(STEPS + 1), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in norm])
        begins = np.concatenate([[0], ends[:-1]])
        starts = window_starts(x[: ends[-1] - 1])
        found = sorted(self.candidates(x, starts), key=lambda c: (c[0], c[2] - c[1]))
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        done = (-1, -1, 0)  # item, text, place up to which it has been compared
        for item, offset, place in found:
            number, wanted = self.items[item]
            size = len(wanted.encode())
            doc = int(np.searchsorted(ends, place, side="right"))
            begin, end = int(begins[doc]), int(ends[doc]) - 1
            most = int((1 - similarity) * len(wanted) + 1e-9)
            room = int((1 - similarity) * size) + 4
            at = place - offset
            if done[:2] == (item, doc) and at <= done[2]:
                continue  # lies in surroundings that were compared
            a, b = max(begin, at - room), min(end, at + size + 2 * room)
            done = (item, doc, at + room // 2)
            text = x[a:b].tobytes().decode(errors="replace")
            distance, stop = distance_within(wanted, text)
            if distance > most:
                continue
            back, length = distance_within(wanted[::-1], text[:stop][::-1])
            before = x[begin:a].tobytes() + text[: stop - length].encode()
            through = before + text[stop - length : stop].rstrip().encode()
            hit = (distance, before.count(b" "), through.count(b" "))
            if number not in out[doc] or hit < out[doc][number]:
                out[doc][number] = hit
        return out


def edited(text: str, edits: int, rng: np.random.Generator) -> str:
    """``text`` after random substitutions, insertions and deletions."""
    out = list(text)
    for k, what, c in zip(rng.random(edits), rng.integers(0, 3, edits), rng.integers(0, 27, edits)):
        at, c = int(k * len(out)), " abcdefghijklmnopqrstuvwxyz"[c]
        out[at : at + (what != 1)] = [] if what == 2 and len(out) > 1 else [c]
    return "".join(out)


def repeats_for(items: list[tuple[int, str]], similarity: float, recall: float) -> int:
    """The number of walks after which the share ``recall`` of edited copies of the items are candidates.

    Some items are too short to reach it with any number of walks; after ``REPEATS`` a warning says what was reached.
    """
    if not items:
        return 1
    rng = np.random.default_rng(7)
    copies = max(1, 200 // len(items))
    owners = [i for i in range(len(items)) for _ in range(copies)]
    texts = [normalised(edited(items[i][1], int((1 - similarity) * len(items[i][1]) + 1e-9), rng)) for i in owners]
    x = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(STEPS + 1), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = window_starts(x[: ends[-1] - 1])
    found: set[int] = set()
    for r in range(REPEATS):
        hits = ((item, int(np.searchsorted(ends, place, side="right"))) for item, _, place in Index(items, [r]).candidates(x, starts))
        found.update(copy for item, copy in hits if owners[copy] == item)
        if len(found) >= recall * len(texts):
            return r + 1
    warnings.warn(f"{REPEATS} walks find {len(found) / len(texts):.2f} of copies at the similarity's limit, not {recall}", stacklevel=2)
    return REPEATS


_INDEXES: dict[int, Index] = {}


def index_of(items: list[tuple[int, str]], repeats: int) -> Index:
    """The index of a block of items, built once per Python worker: only the items travel to the tasks."""
    key = hash((tuple(items), repeats))
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(items, range(repeats))
    return _INDEXES[key]


def item_blocks(benchmark: DataFrame, text: str, item_id: str, size: int = ITEMS) -> Iterator[tuple[list, list[tuple[int, str]]]]:
    """The items in blocks of about ``size``: their ids as given, and (place in that list, normalised text).

    Items without words are left out: they occur everywhere.
    """
    own = benchmark.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    blocks = max(1, -(-own.count() // size))
    for b in range(blocks):
        part = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().collect()
        items = {(r["id"], normalised(r["text"]).decode()) for r in part}
        block = sorted((i for i in items if i[1]), key=lambda i: (i[1], i[0] is None, i[0] if i[0] is not None else 0))
        yield [i for i, _ in block], [(n, t) for n, (_, t) in enumerate(block)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document and item that it contains: doc_id, item_id, distance (edits), start and end.

    ``start`` and ``end`` are code points, in the document's own text, of the words that hold the match; ids
    of any type keep it. Items without words or with a NULL id give no rows; neither do NULL or empty texts. Of several items with one id the
    best match counts; repeated documents give repeated rows. ``recall`` is the share to find of matches
    at the similarity's limit; closer ones are found more often. Empty tables give an empty result. Other
    columns are not read.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    key = benchmark.schema[item_id].dataType.simpleString()
    out = None
    for ids, items in item_blocks(benchmark, item_text, item_id):
        repeats = repeats_for(items, similarity, recall)

        def work(texts: list[str], ids: list = ids, items: list = items, repeats: int = repeats) -> list[list]:
            rows = []
            for t, hits in zip(texts, index_of(items, repeats).matches(texts, similarity)):
                words = [m.span() for m in WORD.finditer(t)] if hits else []
                best: dict = {}
                for n, hit in hits.items():
                    if ids[n] is not None:
                        best[ids[n]] = min(hit, best.get(ids[n], hit))
                rows.append([{"item_id": i, "distance": d, "start": words[a][0], "end": words[b][1]} for i, (d, a, b) in sorted(best.items())])
            return [rows]

        found = map_texts(own, "text", [("hits", f"array<struct<item_id:{key},distance:long,start:long,end:long>>")], work, ["doc_id"])
        rows = found.select("doc_id", F.inline("hits"))
        out = rows if out is None else out.union(rows)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_text: str = "text", item_id: str = "item_id", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows and columns of ``docs`` without the documents that contain an item, whatever its id; nothing is shuffled."""
    marked, named, back = shielded(docs)
    columns = marked.columns
    for _, items in item_blocks(benchmark, item_text, item_id):
        repeats = repeats_for(items, similarity, recall)

        def work(texts: list[str], items: list = items, repeats: int = repeats) -> list[list]:
            return [[bool(hits) for hits in index_of(items, repeats).matches(texts, similarity)]]

        marked = map_texts(marked, named[text], [("leak", "boolean")], work, columns).where("not leak").drop("leak")
    return back(marked)
