"""Secrets in texts: fixed patterns, and random strings found by how badly a tokenizer compresses them.

A vocabulary learned from prose spends one token on several characters of anything people write. A
random string gets few characters per token. Every run of at least ``MIN_CHARS`` key characters is
encoded, with or without digits; below ``MAX_CHARS_PER_TOKEN`` it is reported as kind ``random``, unless
it is a known digest or identifier, a name whose letters read well, or lies in a span that a pattern
already gave. Runs are measured in parts as well, between ``/`` and ``=`` and then between all separators:
readable surroundings do not hide a random part, nor are they reported with it.
"""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame

from fleetlake.llm.common import map_texts

MIN_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.2
KINDS = ("assign", "access", "hex", "random")

# The patterns of the contract, and the shapes of digests and identifiers that are no secrets.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEY = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
KNOWN = [
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"(md5|sha1|sha224|sha256|sha384|sha512)[-_=][A-Za-z0-9+/=_-]+", re.IGNORECASE),  # labelled digest
    re.compile(r"[0-9/_=+-]+"),  # numbers, dates, rules
]
ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")  # bank account numbers
NAME = re.compile(r"[A-Za-z]+([_/-][A-Za-z]+|[_/-]?[0-9]{1,8}(?![0-9]))*")  # words with short numbers; the words have to read well
SEPARATORS = (re.compile("[^/=]+"), re.compile("[^/=+_-]+"))
LETTERS = re.compile("[A-Za-z]{2,}")
HEXADECIMAL = re.compile("[0-9a-f]+|[0-9A-F]+")

_ENCODERS: dict = {}


def encoder(path: str):
    """The tiktoken encoding of a rank file, once per Python worker."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # candidates hold no white space: each is one piece
        _ENCODERS[path] = tiktoken.Encoding("secret-scan", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def is_account(word: str) -> bool:
    """A bank account number whose check digits are right: letters as 10 to 35, the first four characters last, 1 modulo 97."""
    return bool(ACCOUNT.fullmatch(word)) and int("".join(str(int(c, 36)) for c in word[4:] + word[:4])) % 97 == 1


def is_known(word: str) -> bool:
    """Digests and identifiers: public by nature, however random they look."""
    return bool(HEXADECIMAL.fullmatch(word)) and len(word) in DIGEST_LENGTHS or is_account(word) or any(p.fullmatch(word) for p in KNOWN)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns, in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def reads_badly(parts: list[str], path: str) -> bool:
    return sum(map(len, parts)) < MAX_CHARS_PER_TOKEN * sum(len(encoder(path).encode_ordinary(p)) for p in parts)


def is_random(word: str, path: str) -> bool:
    """Few characters per token; of a name with numbers, the words count alone: numbers are no prose, but no secrets either."""
    return reads_badly([word], path) and (not NAME.fullmatch(word) or reads_badly(LETTERS.findall(word), path))


def random_parts(text: str, start: int, end: int, taken: list[tuple[int, int, int]], path: str, level: int = 0) -> list[tuple[int, int, int]]:
    """Random stretches of a run of key characters: its random parts if what lies around them reads well, or else the run."""
    word = text[start:end].strip("=-_/+")
    if len(word) < MIN_CHARS or is_known(word):
        return []
    start = text.index(word, start)
    end = start + len(word)
    parts = []
    if level < len(SEPARATORS):
        parts = [s for m in SEPARATORS[level].finditer(text, start, end) for s in random_parts(text, m.start(), m.end(), taken, path, level + 1)]
    if any(a < end and start < b for a, _, b in taken) or not is_random(word, path):
        return parts
    borders = [start, *[place for a, _, b in parts for place in (a, b)], end]
    rest = LETTERS.findall(" ".join(text[a:b] for a, b in zip(borders[::2], borders[1::2])))
    return parts if rest and not reads_badly(rest, path) else [(start, 3, end)]


def random_spans(text: str, taken: list[tuple[int, int, int]], path: str) -> list[tuple[int, int, int]]:
    return [s for m in KEY.finditer(text) for s in random_parts(text, m.start(), m.end(), taken, path)]


def listed(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus counts per kind, a digest of the pattern spans and all spans of every whole text.

    ``path``: a tiktoken rank file. Spans are ``kind:start:end`` in code points. NULL is an empty text:
    no spans, counts 0, the digest of nothing. Each row is judged alone, so repeated rows and ties give
    equal rows; an empty table gives an empty result; other columns are not read.
    """

    def work(texts: list[str]) -> list[list]:
        counts, digests, spans = [[], [], [], []], [], []
        for t in texts:
            base = base_spans(t)
            more = random_spans(t, base, path)
            kinds = [k for _, k, _ in (*base, *more)]
            for k, column in enumerate(counts):
                column.append(kinds.count(k))
            digests.append(hashlib.sha256(listed(base, KINDS).encode()).hexdigest())
            spans.append(listed(sorted(base + more), KINDS))
        return [*counts, digests, spans]

    fields = [(f"n_{k}", "long") for k in KINDS] + [("base_sha256", "string"), ("spans", "string")]
    return map_texts(docs, text, fields, work, keep)
