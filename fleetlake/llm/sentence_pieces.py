"""SentencePiece BPE, encoded by vectorised merge rounds and decoded from flat arrays.

A text is cut into words before each blank (no piece holds a blank behind another character). The
words not met lately are encoded together: their symbols lie in one flat array, cut further wherever
two neighbouring characters are neighbours in no piece, so nothing can be merged across a cut. In a round
every segment finds the least rank among its pairs (a segmented minimum) and merges all pairs of that
rank, leftmost first where they overlap; then the array is compacted. Segments without a pair leave.

One merge at a time gives the same result: a merge can only make a pair of better rank if its piece
begins or ends a piece of better rank. Such pieces are known from the vocabulary; of their pairs only
the leftmost of a segment is merged in a round. Pieces of blanks only come after all others and have one rank, so
runs of single blanks are put together at the end, leftmost pair first.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from fleetlake.llm.common import map_texts

BLANK = "▁"
MAX_WORDS = 400_000
MAX_POINTS = 8_000_000
UNKNOWN, CONTROL, BYTE = 2, 3, 6  # piece types of the file format; 1 is an ordinary piece
_NO_RANK = np.int32(2**31 - 1)
_BIGRAMS = 1 << 22


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, raw[at : at + size]
            at += size


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes of the runs (start, count), one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


class Model:
    """One model file: pieces, ranks of pairs, and the words met lately."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        rows = [dict(_fields(v)) for n, v in parts if n == 1]
        self.pieces = [r[1].decode() for r in rows]
        kind = [r.get(3, 1) for r in rows]
        score = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        trainer = next((dict(_fields(v)) for n, v in parts if n == 2), {})
        normal = next((dict(_fields(v)) for n, v in parts if n == 3), {})
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24, 0) or normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1) or set(kind) - {1, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: only BPE with byte fallback, a blank put before the text and no normalisation")
        ordinary = {p: i for i, (p, k) in enumerate(zip(self.pieces, kind)) if k == 1}
        blanks = {len(p): i for p, i in ordinary.items() if not p.strip(BLANK)}
        worst = min(score[i] for i in ordinary.values())
        longer = [p for p in ordinary if p.strip(BLANK)]
        if 1 not in blanks or any(score[i] != worst for n, i in blanks.items() if n > 1) or any(BLANK in p[1:] for p in longer) or any(score[ordinary[p]] <= worst for p in longer if len(p) > 1):
            raise ValueError(f"{path}: blanks inside pieces, or pieces of blanks that come before others")
        self.blanks = blanks
        self.blank_runs: dict[int, np.ndarray] = {}
        self.end, self.unknown = next((i for i, p in enumerate(self.pieces) if p == "</s>"), 2), kind.index(UNKNOWN)
        self.kind = np.array(kind)
        self._pairs({p: i for p, i in ordinary.items() if p.strip(BLANK) or p == BLANK}, score)
        self.byte_id = np.zeros(256, np.int64)
        surface = []
        for i, (p, k) in enumerate(zip(self.pieces, kind)):
            if k == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
                surface.append(bytes([int(p[3:5], 16)]))
            else:
                surface.append(p.replace(BLANK, " ").encode() if k == 1 else b" \xe2\x81\x87 " if k == UNKNOWN else b"")
        self.sizes = np.array([len(s) for s in surface])
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.decimal = np.array([f"{i} ".encode() for i in range(len(kind))])
        self._forget()

    def _pairs(self, pieces: dict[str, int], score: Sequence[float]) -> None:
        """Symbols (ids; characters without one get numbers beyond), pair -> (rank, merged symbol), cuts and unsafe ranks."""
        symbol = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - set(pieces)):
            symbol[c] = len(self.pieces) + len(symbol) - len(pieces)
        self.n_symbols = max(len(self.pieces), max(symbol.values()) + 1)
        # the pieces' own numbers are their symbols; a character that is no piece has no id of its own
        order = sorted({score[i] for i in pieces.values()}, reverse=True)
        rank = {s: n for n, s in enumerate(order)}
        keys, ranks, made, unsafe = [], [], [], set()
        for p, i in pieces.items():
            mine = rank[score[i]]
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in symbol and b in symbol:
                    keys.append(symbol[a] * self.n_symbols + symbol[b])
                    ranks.append(mine)
                    made.append(i)
                unsafe.update(rank[score[pieces[x]]] for x in (a, b) if x in pieces and rank[score[pieces[x]]] >= mine)
        at = np.argsort(keys)
        self.keys, self.ranks, self.made = np.array(keys, np.int64)[at], np.array(ranks, np.int32)[at], np.array(made, np.int64)[at]
        self.unsafe = np.zeros(len(order) + 1, bool)
        self.unsafe[list(unsafe)] = True
        self.point_symbol = np.full(0x110000, -1, np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.point_symbol[ord(p)] = i
        # a table of neighbours: a wrong hit leaves a segment uncut, which changes nothing
        self.neighbours = np.zeros(_BIGRAMS, bool)
        both = np.array([(ord(a), ord(b)) for p in pieces for a, b in zip(p, p[1:])], np.int64)
        self.neighbours[self._slot(both[:, 0], both[:, 1])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 2477 + b) & (_BIGRAMS - 1)

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.points = 0
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    # --- encoding ---

    def merge_rounds(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge within segments until no pair remains: (symbols, segments), segments ascending."""
        done_s, done_g = [], []
        while len(symbols):
            key = symbols[:-1] * self.n_symbols + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (segment[:-1] == segment[1:]) & (symbols[1:] < self.n_symbols)
            rank = np.append(np.where(hit, self.ranks[at], _NO_RANK), _NO_RANK)
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(rank, first)
            over = np.repeat(least == _NO_RANK, sizes)
            if over.any():
                done_s.append(symbols[over])
                done_g.append(segment[over])
            chosen = ~over & (rank == np.repeat(least, sizes))
            place = np.flatnonzero(chosen)
            if len(place):
                # of pairs that overlap every second one; of an unsafe rank the first in its segment
                fresh = np.concatenate([[True], np.diff(place) != 1])
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
                take = (np.arange(len(place)) - run) % 2 == 0
                head = np.concatenate([[True], segment[place[1:]] != segment[place[:-1]]])
                take &= head | ~self.unsafe[rank[place]]
                place = place[take]
                symbols = symbols.copy()
                symbols[place] = self.made[at[place]]
                over[place + 1] = True
            symbols, segment = symbols[~over], segment[~over]
        if not done_s:
            return symbols, segment
        symbols, segment = np.concatenate(done_s), np.concatenate(done_g)
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def _learn(self, words: list[str]) -> None:
        """Encode words (each stands behind a blank) and keep their ids."""
        joined = BLANK + BLANK.join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) + 1 for w in words])
        begins = np.zeros(len(points), bool)
        begins[np.cumsum(lengths) - lengths] = True
        word = np.cumsum(begins) - 1
        cut = begins.copy()
        cut[1:] |= ~self.neighbours[self._slot(points[:-1], points[1:])]
        symbols, segment = self.point_symbol[points].astype(np.int64), np.cumsum(cut) - 1
        # characters in no piece stand alone; the number behind the symbols keeps their code point
        symbols = np.where(symbols < 0, self.n_symbols + points, symbols)
        # a segment of one symbol is done; the others go through the rounds
        single = cut & np.append(cut[1:], True)
        merged, of = self.merge_rounds(symbols[~single], segment[~single])
        word_of = np.zeros(segment[-1] + 1, np.int64)
        word_of[segment] = word
        all_s, all_g = np.concatenate([symbols[single], merged]), np.concatenate([segment[single], of])
        order = np.argsort(all_g, kind="stable")
        all_s, owner = all_s[order], word_of[all_g[order]]
        ids, sizes = self._with_bytes(all_s)
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, owner, sizes)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        known = len(self.number)
        self.number.update(zip(words, range(known, known + len(words))))
        self.points += len(points)

    def _with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each symbol): a symbol that is no piece becomes the ids of its UTF-8 bytes."""
        odd = np.flatnonzero(symbols >= len(self.pieces))
        sizes = np.ones(len(symbols), np.int64)
        if not len(odd):
            return symbols, sizes
        kinds, back = np.unique(symbols[odd], return_inverse=True)
        extra = {int(self.point_symbol[p]): p for p in np.flatnonzero(self.point_symbol >= len(self.pieces))}
        made = [self.byte_id[list(chr(s - self.n_symbols if s >= self.n_symbols else extra[int(s)]).encode())] for s in kinds.tolist()]
        length = np.array([len(m) for m in made])
        sizes[odd] = length[back]
        ids = np.repeat(symbols, sizes)
        ends = np.cumsum(sizes)
        ids[spread(ends[odd] - sizes[odd], sizes[odd])] = np.concatenate([made[k] for k in back.tolist()])
        return ids, sizes

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text; no end id."""
        lists = [t.replace(BLANK, " ").split(" ") if t else [] for t in texts]
        words = [w for ws in lists for w in ws]
        if len(self.number) > MAX_WORDS or self.points > MAX_POINTS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        counts = self.counts[number]
        ids = self.flat[spread(self.starts[number], counts)].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        upto = ends[np.cumsum([len(ws) for ws in lists])] if len(texts) else np.zeros(0, np.int64)
        return self._join_blanks(ids, np.diff(upto, prepend=0))

    def _blank_run(self, n: int) -> np.ndarray:
        """Ids of ``n`` blanks in a row: all their pieces have one rank, so the leftmost pair that is a piece goes first."""
        if n not in self.blank_runs:
            settled: list[int] = []  # no pair among these is a piece
            for _ in range(n):
                settled.append(1)
                while len(settled) > 1 and settled[-2] + settled[-1] in self.blanks:
                    settled[-2:] = [settled[-2] + settled[-1]]
            self.blank_runs[n] = np.array([self.blanks[p] for p in settled])
        return self.blank_runs[n]

    def _join_blanks(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put together the runs of single blanks within each text."""
        lone = ids == self.blanks[1]
        follows = np.zeros(len(ids), bool)
        follows[1:] = lone[1:] & lone[:-1]
        begin = np.cumsum(counts) - counts
        follows[begin[counts > 0]] = False
        heads = np.flatnonzero(~follows & np.append(follows[1:], False)) if len(ids) else np.zeros(0, np.int64)
        if not len(heads):
            return ids, counts
        stays = np.flatnonzero(~follows)
        lengths = np.diff(np.append(stays, len(ids)))[np.searchsorted(stays, heads)]
        runs = [self._blank_run(n) for n in lengths.tolist()]
        sizes = (~follows).astype(np.int64)
        sizes[heads] = [len(r) for r in runs]
        out, ends = np.repeat(ids, sizes), np.concatenate([[0], np.cumsum(sizes)])
        out[spread(ends[heads], sizes[heads])] = np.concatenate(runs)
        return out, ends[begin + counts] - ends[begin]

    # --- decoding ---

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids: blanks for their mark, bytes put together, the first blank dropped.

        Control ids give nothing; bytes that are not UTF-8 give U+FFFD each.
        """
        sizes = self.sizes[ids]
        raw = self.bytes[spread(self.offsets[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        stops = np.cumsum(counts)
        out = []
        for a, b in zip((stops - counts).tolist(), stops.tolist()):
            while a < b and self.kind[ids[a]] == CONTROL:
                a += 1
            start = int(ends[a])
            if a < b and self.pieces[ids[a]].startswith(BLANK):
                start += 1
            part = raw[start : int(ends[b])]
            try:
                out.append(part.decode())
            except UnicodeDecodeError:
                out.append(self._repaired(ids[a:b]))
        return out

    def _repaired(self, ids: np.ndarray) -> str:
        """Decoding where runs of byte ids are no UTF-8: each byte that fits nothing becomes U+FFFD."""
        out, run = [], bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for size in range(1, 5):
                    try:
                        out.append(bytes(run[at : at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                at += size
            run.clear()

        for n, i in enumerate(ids.tolist()):
            if self.kind[i] == BYTE:
                run += self.bytes[self.offsets[i] : self.offsets[i] + 1].tobytes()
                continue
            close()
            piece = self.bytes[self.offsets[i] : self.offsets[i] + self.sizes[i]].tobytes().decode()
            out.append(piece[1:] if n == 0 and self.pieces[i].startswith(BLANK) else piece)
        close()
        return "".join(out)


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file, once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end: bool = True) -> DataFrame:
    """``keep`` plus ids (array of int, the end id last if asked for) of every whole text; NULL counts as the empty text."""

    def work(texts: list[str]) -> list[list]:
        own = model(path)
        ids, counts = own.encode(texts)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        return [[[*p.tolist(), own.end] if end else p.tolist() for p in parts]]

    return map_texts(docs, text, [("ids", "array<int>")], work, keep)


def sentence_pieces(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus n_tokens, ids_sha256 and decoded_sha256 of every whole text, encoded with an end id and decoded again.

    NULL counts as the empty text, which has the end id only. Repeated rows stay; an empty table gives an empty
    result; other columns are not read. A kept column named like a result gives way to the result.
    """

    def work(texts: list[str]) -> list[list]:
        own = model(path)
        ids, counts = own.encode(texts)
        decoded = own.decode(ids, counts)
        stops = np.cumsum(counts)
        last = str(own.end).encode()
        listed = [hashlib.sha256(own.decimal[ids[a:b]].tobytes().translate(None, b"\0") + last).hexdigest() for a, b in zip((stops - counts).tolist(), stops.tolist())]
        return [(counts + 1).tolist(), listed, [hashlib.sha256(t.encode()).hexdigest() for t in decoded]]

    return map_texts(docs, text, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], work, keep)
