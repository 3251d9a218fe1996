"""Token counts by a byte-level BPE vocabulary compiled into two finite-state transducers.

The *splitter* reads character classes and says where a piece begins. It has eight states, so what a
stretch of text does to them is one of a few hundred state maps. Texts are cut into chunks; every
chunk's map is built in step with all others, a parallel prefix scan composes the maps, and so each
chunk knows the state it starts in, however long the text is.

The *merger* reads the bytes of a piece. Its states hold, for each suffix that may still grow into a
vocabulary entry, which token ended before the suffix and how many tokens lay there; each transition
is annotated with the tokens it adds (merging may make that negative). It is deterministic and, as
tokens are short, finite; states are made when first reached, as in a lazy DFA, and are dropped and
made again beyond ``MAX_STATES``. A transition picks the only token that ends at the new byte and may
follow what lies before it: a pair may stand side by side exactly if merging its bytes gives it back.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import map_texts

CHUNK = 256
MAX_STATES = 400_000
MAX_PIECES = 400_000

# Symbols of the splitter: letter, number, other, white space before white space or the end, the last
# of a run (any but a blank / a blank), an apostrophe that begins a contraction of 2 / 3 characters, end of text, nothing.
LETTER, NUMBER, OTHER, SPACE, LAST, BLANK, SHORT, LONG, END, NOTHING = range(10)
# States: between pieces, inside a run of letters / numbers / others / white space, after a blank, inside a contraction with 1 / 2 to go.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_BLANK, ONE_LEFT, TWO_LEFT = range(8)
# The code points with the Unicode property White_Space, as ranges.
WHITE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece begins here" for each (state, symbol)."""
    opens = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPACE: IN_SPACE, LAST: FREE, BLANK: AFTER_BLANK, SHORT: ONE_LEFT, LONG: TWO_LEFT}
    joins = {IN_LETTERS: {LETTER}, IN_NUMBERS: {NUMBER}, IN_OTHERS: {OTHER, SHORT, LONG}, IN_SPACE: {SPACE}, AFTER_BLANK: {LETTER, NUMBER, OTHER, SHORT, LONG}}
    after, begins = np.zeros((8, 10), np.int64), np.zeros((8, 10), bool)
    for state in range(8):
        for symbol, opened in opens.items():
            if state in (ONE_LEFT, TWO_LEFT):
                after[state, symbol] = FREE if state == ONE_LEFT else ONE_LEFT
            elif symbol in joins.get(state, ()):
                after[state, symbol] = IN_OTHERS if symbol in (SHORT, LONG) else opened
            else:
                after[state, symbol], begins[state, symbol] = opened, True
        after[state, END], after[state, NOTHING] = FREE, state
    return after, begins


def _state_maps(after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All state maps that symbols can compose to, map x symbol -> map, and map x map -> map."""
    maps = [tuple(range(8))]
    number = {maps[0]: 0}
    step = []
    for m in maps:  # grows while it is read
        row = []
        for symbol in range(10):
            new = tuple(int(after[s, symbol]) for s in m)
            if new not in number:
                number[new] = len(maps)
                maps.append(new)
            row.append(number[new])
        step.append(row)
    table = np.array(maps)
    both = np.array([[number[tuple(int(x) for x in table[b][table[a]])] for b in range(len(maps))] for a in range(len(maps))])
    return table, np.array(step).ravel(), both


def _classes() -> np.ndarray:
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for symbol, property_ in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(property_, everything):
            at = [i + 0x800 if i >= 0xD800 else i for i in (m.start(), m.end() - 1)]
            out[at[0] : at[1] + 1] = symbol
    for a, b in WHITE:
        out[a : b + 1] = SPACE
    return out


class Merger(dict):
    """piece (bytes) -> its number of tokens; the transducer runs once for each piece not met lately."""

    def __init__(self, vocab: dict[bytes, int], merges: dict[tuple[bytes, bytes], int]):
        super().__init__()
        self.vocab, self.merges = vocab, merges
        self.longer = {t[:n] for t in vocab for n in range(1, len(t))}
        self.made_by: dict[bytes, tuple[int, tuple[bytes, bytes]]] = {}
        for pair, rank in merges.items():
            self.made_by.setdefault(pair[0] + pair[1], (rank, pair))
        self.spines: dict[tuple[bytes, int], list[tuple[bytes, int, float]]] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple] = [((b"", b"", 0),)]
        self.number = {self.states[0]: 0}
        self.move: dict[int, tuple[int, int]] = {}

    def merged(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.merges.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int, float]]:
        """The parts of a token that touch its left (0) or right (1) edge: (part, rank that makes it, rank that uses it up)."""
        key = (token, side)
        if key not in self.spines:
            out, used = [], float("inf")
            while True:
                rank, halves = self.made_by.get(token, (-1, None))
                out.append((token, rank, used))
                if halves is None:
                    break
                token, used = halves[side], rank
            self.spines[key] = out
        return self.spines[key]

    def may_follow(self, before: bytes, token: bytes) -> bool:
        """Merging the bytes of both gives them back: no pair across the border is merged while both of its parts exist.

        Of equal pairs the left one is merged first, so a rank that uses up the right part does not save it.
        """
        key = (before, token)
        if key not in self.fits:
            if not before:
                self.fits[key] = self.merged(token) == [token]
            else:
                self.fits[key] = self.may_follow(b"", token) and not any(
                    made_a < rank < used_a and made_b < rank <= used_b
                    for a, made_a, used_a in self._spine(before, 1)
                    for b, made_b, used_b in self._spine(token, 0)
                    if (rank := self.merges.get((a, b))) is not None
                )
        return self.fits[key]

    def _transition(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens added). A live entry: (bytes since a position, token that ends there, tokens up to there less those up to here)."""
        b = bytes([byte])
        live, chosen = self.states[state], None
        for since, before, tokens in live:  # longest first
            token = since + b
            if token in self.vocab and self.may_follow(before, token):
                chosen = (token, tokens + 1)
                break
        token, added = chosen
        grown = tuple((since + b, before, tokens - added) for since, before, tokens in live if since + b in self.longer)
        new = (*grown, (b"", token, 0))
        if new not in self.number:
            self.number[new] = len(self.states)
            self.states.append(new)
        out = self.move[state << 8 | byte] = (self.number[new], added)
        return out

    def __missing__(self, piece: bytes) -> int:
        if len(self) > MAX_PIECES:
            self.clear()
        if len(self.states) > MAX_STATES:
            self._restart()
            self.fits.clear()
        state, tokens, move = 0, 0, self.move
        for byte in piece:
            state, added = move.get(state << 8 | byte) or self._transition(state, byte)
            tokens += added
        self[piece] = tokens
        return tokens


class Compiled:
    """Both transducers of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path}: only byte-level vocabularies without a normaliser or prefix space")
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        raw = lambda s: bytes(byte_of[c] for c in s)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        vocab = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.merger = Merger(vocab, {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)})
        self.after, self.begins = _splitter()
        self.maps, self.step, self.both = _state_maps(self.after)
        self.classes = _classes()

    def symbols(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The splitter's symbol of each code point; ``ends`` marks points that are outside any piece."""
        c = self.classes[points]
        c[ends] = END
        p = np.where(ends, 0, points)
        after1, after2 = np.append(p[1:], 0), np.append(p[2:], [0, 0])[: len(p)]
        c1 = np.append(c[1:], np.uint8(END))
        last = (c == SPACE) & (c1 != SPACE) & (c1 != END)
        c = np.where(last, np.where(p == 32, BLANK, LAST), c)
        mark = (p == 39) & (c == OTHER)
        if mark.any():
            is1 = lambda s: np.isin(after1, [ord(x) for x in s])
            long = ((after1 == ord("r")) | (after1 == ord("v"))) & (after2 == ord("e")) | (after1 == ord("l")) & (after2 == ord("l"))
            c = np.where(mark & is1("stmd"), SHORT, np.where(mark & long, LONG, c))
        return c

    def split(self, symbols: np.ndarray) -> np.ndarray:
        """True where a piece begins: chunk maps, prefix scan over them, then one run from known states."""
        n = len(symbols)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, NOTHING, np.int64)
        grid[:n] = symbols
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        chunk = np.zeros(rows, np.int64)
        for column in grid:
            chunk = self.step[chunk * 10 + column]
        reach = 1
        while reach < rows:  # inclusive scan: each entry composes what came before with itself
            chunk[reach:] = self.both[chunk[:-reach], chunk[reach:]]
            reach *= 2
        state = np.zeros(rows, np.int64)
        state[1:] = self.maps[chunk[:-1], FREE]
        begins = np.empty((CHUNK, rows), bool)
        after, flags = self.after.ravel(), self.begins.ravel()
        for i, column in enumerate(grid):
            at = state * 10 + column
            begins[i] = flags[at]
            state = after[at]
        return begins.T.ravel()[:n]

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """UTF-8 bytes and tokens of each text."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        ends = np.zeros(len(points), bool)
        ends[stops] = True
        extra = np.zeros(len(texts), np.int64)
        if self.special:
            for i, t in enumerate(texts):
                for m in self.special.finditer(t):
                    base = stops[i] - len(t)
                    ends[base + m.start() : base + m.end()] = True
                    extra[i] += 1
        begins = self.split(self.symbols(points, ends))
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        offset = np.concatenate([[0], np.cumsum(width)])
        events = np.flatnonzero(begins | ends)
        starts = begins[events]
        a = offset[events[starts]].tolist()
        b = offset[np.append(events[1:], len(points))[starts]].tolist()
        raw, known = joined.encode(), self.merger
        made = np.fromiter((known[raw[i:j]] for i, j in zip(a, b)), np.int64, len(a))
        total = np.concatenate([[0], np.cumsum(made)])
        upto = total[np.searchsorted(events[starts], stops)]
        tokens = np.diff(upto, prepend=0) + extra
        last = offset[stops]
        sizes = last - np.concatenate([[0], last[:-1] + 1])
        return sizes.tolist(), tokens.tolist()


_COMPILED: dict[str, Compiled] = {}


def compiled(path: str) -> Compiled:
    """The transducers of a file, once per Python worker."""
    if path not in _COMPILED:
        _COMPILED[path] = Compiled(path)
    return _COMPILED[path]


def token_counts(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """``keep`` plus n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text.

    NULL counts as the empty text: 0 bytes, 0 tokens. Special strings inside a text count one token
    each. Repeated rows stay; an empty table gives an empty result; other columns are not read. A
    kept column named like a result gives way to the result.
    """

    def work(texts: list[str]) -> list[list]:
        sizes, tokens = compiled(path).count(texts)
        return [sizes, tokens]

    out = map_texts(docs, text, [("n_bytes", "long"), ("n_tokens", "long")], work, [k for k in keep if k != "over_limit"])
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
