"""Personal data in texts: fixed patterns, and a linear-chain conditional random field over word shapes.

The field labels words. A word is described by its shape (digits, letters, marks, length classes) and
by cue words before it; transitions tie the words of one item together. It is trained in numpy on the
labelled table below (maximum likelihood, forward-backward, gradient steps from zero: always the same
weights). Decoding packs the sequences of a batch side by side and runs Viterbi over all of them at once.

A sequence is a stretch of words around words that hold a digit, an ``@``, a bracketed ``at`` or ``dot``,
or that are ``at`` or ``dot``, in any case, with ``CONTEXT`` words on either side; stretches that touch are
one sequence. Every item of the labelled table holds such a word; words elsewhere are not decoded.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import map_texts, shielded

CONTEXT = 3
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "email", "+email", "ip", "+ip", "card", "+card", "phone", "+phone")  # + goes on with the item

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = frozenset("\x20\x09\x0a\x0b\x0c\x0d")
SEED = re.compile(r"[0-9@]|[\[({](?:[aA][tT]|[dD][oO][tT])[\])}]|(?:[aA][tT](?<![^\x20\x09-\x0D,.;:]..)|[dD][oO][tT](?<![^\x20\x09-\x0D,.;:]...))(?![^\x20\x09-\x0D,.;:])")
EDGE_LEFT, EDGE_RIGHT = "\"'<[{:;,.!?|*#$%&=", "\"'>]});:,.!?|*#$%&="

# The labelled table. An item stands in braces: {kind words}; everything else is no personal data.
LABELLED = """
please call me at {phone (030) 555-0199} after six
her number is {phone (212) 555-7713} and she is at home
tel {phone 030 5550199} or fax {phone 030 5550198}
phone: {phone 555-201-7788} daily
mobile {phone 0171 555 2091} only in the evening
tel. {phone 0033 1 55 50 19 21} for orders
call {phone 1-800-555-0134} now
phone {phone (044) 555 28 31} please
and then {phone (917) 555-0146} was the one
the number {phone (503) 555-0173} of the house
teléfono {phone 91 555 01 22} por la tarde
téléphone {phone 01 55 50 12 34} le soir
telefon {phone 0221 5550187} am abend
write to {email anna [at] example [dot] com} today
mail {email j.doe(at)example.org} for more
e-mail: {email max at example dot net} please
contact {email sales at example dot com}
write to {email bob at example dot org} soon
ask {email jane.roe at mail dot example dot org} about it
{email office at example dot co dot uk}
they met at home and looked at the red dot on the wall
not at all, said the man at the door, look at me
she arrived at the station at noon and wrote at once to the team
contact us at the office for help or mail it at your own cost
a dot at the end of line and the dot com boom at its height
contact {email info[at]mail3.example.com} for help
email {email joe@localhost} on the machine
card {card 4111-1111-1111-1112} was charged
my card number is {card 4929 1111 2222 3333} and it expires
card: {card 5500005555555559} is old
credit card {card 378282246310006} was refused
carte {card 4970 1111 2222 3334} est perdue
tarjeta {card 4548 8120 4940 0005} es nueva
kreditkarte {card 5232 0500 0001 7890} ist neu
server at {ip 10.0.0.1:8080} is down
host {ip 2001:db8::8a2e:370:7334} answers
address {ip fe80::1ff:fe23:4567:890a} is local
ip {ip 192.168.0.1/24} is the net
in 1999 there were 12 of them and 3 more
the order 4739201847561029 was sent on 2021-04-05 to the shop
number 9938471029384756 and 8273645546372819 were drawn
see section 4.2.1 and page 17 of the book
version 1.2.3 and build 4412 came out at 10:30
it cost 1,250.00 or 30 % less than 99.95
call 3 of them at 12 today
he was born in 1957 and died in 2004 in a house with 20 rooms
token = "e7fbfec6a80404dc513b99d3fdbf2a6e53400638" is there
creative commons by-nc 4.0. and 3. of the kind
a b2b or 4x4 or mp3 of 128 kbit and h2o
isbn 978-3-16-148410-0 of the first edition
@anna and @max wrote at 9 about the 2nd part
from 1914-1918 and 1939-1945 the war
the score was 3-2 then 21-15 and (2020) again
invoice 2023-000123 for item 555-0001-x of 1 (2) kind
id 123e4567-e89b-12d3-a456-426614174000 of the row
meet at 10 at the dot on the map
released under cc by-nc 4.0 in 2019 with 1 (one) change
the (017) form and the 555 rule
"""

# Words that announce an item, by the kind they announce.
CUES = {
    "phone": "phone tel telephone call mobile fax cell teléfono téléphone telefon telefono handy".split(),
    "email": "email e-mail mail contact write".split(),
    "card": "card credit carte tarjeta kreditkarte visa mastercard".split(),
    "ip": "ip server host address".split(),
}
CUE_OF = {w: i for i, words in enumerate(CUES.values()) for w in words}
AT_WORDS = {"at", "[at]", "(at)", "{at}"}
DOT_WORDS = {"dot", "[dot]", "(dot)", "{dot}"}

# --- features ---


@cache
def _shape_names() -> list[str]:
    return [
        "bias", "digit", "digits only", "1-2 digits", "3-4 digits", "5-8 digits", "9-11 digits", "12-19 digits", "20 digits", "@", "@ inside", "obfuscated @", "at word", "dot word", "3 dots of digits",
        "port or mask", "colons of hex", "(digits)", "opens (", "4-digit groups", "dashed groups", "phone groups", "ends short", "dotted", "letters", "3+ letters", "mixed", "first 0", "date", "plain", "starts 19 or 20",
    ]


HEXGROUPS = re.compile(r"[0-9a-f]{0,4}(:[0-9a-f]{0,4}){3,7}", re.IGNORECASE)
DATE = re.compile(r"(19|20)\d\d-\d{1,4}(-\d{1,2})?|\d\d?[:.]\d\d")


def features(words: list[str]) -> list[list[int]]:
    """Numbers of the features that hold for each word: its own shape, the shapes beside it, cues up to three words before."""
    n = len(_shape_names())
    shapes, cues = [], []
    for word in words:
        w = word.strip(EDGE_LEFT[:2] + EDGE_RIGHT)
        digits = sum(c in "0123456789" for c in w)
        letters = sum(c.isalpha() for c in w)
        rest = len(w) - digits - letters
        low = w.lower()
        tests = [
            True, digits > 0, digits == len(w) > 0, 1 <= digits <= 2, 3 <= digits <= 4, 5 <= digits <= 8, 9 <= digits <= 11, 12 <= digits <= 19, digits >= 20, "@" in w, 0 < w.find("@") < len(w) - 1,
            bool(re.search(r"\w[\[({]at[\])}]\w", low)), word.lower().strip(",.;:") in AT_WORDS, word.lower().strip(",.;:") in DOT_WORDS, bool(re.fullmatch(r"\d+(\.\d+){3}", w)),
            bool(re.fullmatch(r"\d+(\.\d+){3}[:/]\d+", w)), bool(HEXGROUPS.fullmatch(w)), bool(re.fullmatch(r"\(\d+\)?", w)), w.startswith("("), bool(re.fullmatch(r"(\d{4}-){3}\d{1,4}", w)),
            bool(re.fullmatch(r"(\d+-){1,}\d+", w)), bool(re.fullmatch(r"(\d-)?\d{3}-\d{4}|(\d-)?\d{3}-\d{3}-\d{4}", w)), word != word.rstrip(".,;:!?"), "." in w, letters > 0, letters >= 3 and not digits, letters > 0 and digits > 0,
            w.startswith("0") and digits == len(w), bool(DATE.fullmatch(w)), digits == 0 and rest == 0, w[:2] in ("19", "20") and digits == 4,
        ]
        shapes.append([i for i, t in enumerate(tests) if t])
        cues.append(CUE_OF.get(low.strip(".()"), -1))
    out = []
    for i in range(len(words)):
        row = list(shapes[i])
        row += [n + f for f in (shapes[i - 1] if i else [])] + [2 * n + f for f in (shapes[i + 1] if i + 1 < len(words) else [])]
        near = {cues[j] for j in range(max(0, i - 3), i)} - {-1}
        own = set(shapes[i])
        row += [3 * n + c for c in near]
        # a cue counts most together with the kind of number it announces
        row += [3 * n + 4 + c * n + f for c in near for f in own]
        out.append(row)
    return out


def n_features() -> int:
    n = len(_shape_names())
    return 3 * n + 4 + 4 * n


# --- training ---


def labelled_rows() -> list[tuple[list[str], list[int]]]:
    rows = []
    for line in LABELLED.strip().split("\n"):
        words, labels = [], []
        for part in re.findall(r"\{(\w+) (.*?)\}(?=\s|$)|([^\s{]+)", line):
            kind, item, plain = part
            if kind:
                for j, w in enumerate(item.split()):
                    words.append(w)
                    labels.append(LABELS.index(kind if j == 0 else "+" + kind))
            else:
                words.append(plain)
                labels.append(0)
        rows.append((words, labels))
    return rows


def allowed() -> np.ndarray:
    """0 where a label may follow another, a large penalty where +kind follows another kind."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for a, before in enumerate(LABELS):
        for b, after in enumerate(LABELS):
            if after.startswith("+") and before.lstrip("+") != after[1:]:
                out[a, b] = -1e4
    return out


def train(rows: list[tuple[list[str], list[int]]], steps: int = 300, rate: float = 0.1, penalty: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Emission (features x labels) and transition weights by maximum likelihood with a Gaussian prior."""
    size, feats, k = n_features(), [features(w) for w, _ in rows], len(LABELS)
    longest = max(len(w) for w, _ in rows)
    phi = np.zeros((len(rows), longest, size), np.float64)
    mask, gold = np.zeros((len(rows), longest), bool), np.zeros((len(rows), longest), np.int64)
    for r, ((words, labels), fs) in enumerate(zip(rows, feats)):
        mask[r, : len(words)], gold[r, : len(words)] = True, labels
        for i, f in enumerate(fs):
            phi[r, i, f] = 1
    hot = np.eye(k)[gold] * mask[..., None]
    seen_e = np.einsum("rif,ril->fl", phi, hot)
    seen_t = np.einsum("rib,ric->bc", hot[:, :-1], hot[:, 1:])
    emit, move, rules = np.zeros((size, k)), np.zeros((k, k)), allowed()
    first = np.array([-1e4 if x.startswith("+") else 0.0 for x in LABELS])
    state = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        e, t = phi @ emit, move + rules
        fwd, back = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0] + first
        for i in range(1, longest):
            new = lse(fwd[:, i - 1][:, :, None] + t, 1) + e[:, i]
            fwd[:, i] = np.where(mask[:, i][:, None], new, fwd[:, i - 1])
        for i in range(longest - 2, -1, -1):
            new = lse(t + (e[:, i + 1] + back[:, i + 1])[:, None, :], 2)
            back[:, i] = np.where(mask[:, i + 1][:, None], new, 0)
        z = lse(fwd[:, -1], 1)[:, None]
        p = np.exp(fwd + back - z[..., None]) * mask[..., None]
        pair = np.exp(fwd[:, :-1, :, None] + t + (e + back)[:, 1:, None, :] - z[..., None, None]) * mask[:, 1:, None, None]
        for weights, grad, (m, v) in ((emit, seen_e - np.einsum("rif,ril->fl", phi, p), state[:2]), (move, seen_t - pair.sum((0, 1)), state[2:])):
            grad = grad - penalty * weights
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            weights += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return emit, move + rules


_MODEL: list = []


def model() -> tuple[np.ndarray, np.ndarray]:
    """The field's weights; trained once per process, always to the same values."""
    if not _MODEL:
        _MODEL.append(train(labelled_rows()))
    return _MODEL[0]


# --- decoding ---


def viterbi(emission: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """The best labels of each sequence; sequences of like length step together."""
    out: list = [None] * len(emission)
    first = np.array([-1e4 if x.startswith("+") else 0.0 for x in LABELS])
    order = sorted(range(len(emission)), key=lambda i: len(emission[i]))
    for at in range(0, len(order), 512):
        batch = order[at : at + 512]
        longest = max(len(emission[i]) for i in batch)
        e = np.zeros((len(batch), longest, len(LABELS)))
        sizes = np.array([len(emission[i]) for i in batch])
        for r, i in enumerate(batch):
            e[r, : sizes[r]] = emission[i]
        best = e[:, 0] + first
        back = np.zeros((longest, len(batch), len(LABELS)), np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + move
            back[t] = through.argmax(1)
            best = np.where((t < sizes)[:, None], through.max(1) + e[:, t], best)
        label = best.argmax(1)
        path = np.zeros((len(batch), longest), np.int64)
        rows = np.arange(len(batch))
        for t in range(longest - 1, -1, -1):
            path[:, t] = label
            if t:
                label = np.where(t < sizes, back[t, rows, label], label)
        for r, i in enumerate(batch):
            out[i] = path[r, : sizes[r]]
    return out


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Stretches of words, as (start, end), around words that ``SEED`` matches."""
    out: list[list[tuple[int, int]]] = []
    done, n = 0, len(text)  # words before ``done`` are in a sequence or have been passed
    m = SEED.search(text)
    while m:
        at = m.start()
        # the words before it, back to CONTEXT of them
        before, i = [], at
        while i > done and text[i - 1] not in BLANKS:
            i -= 1
        own = i
        for _ in range(CONTEXT):
            while i > done and text[i - 1] in BLANKS:
                i -= 1
            stop = i
            while i > done and text[i - 1] not in BLANKS:
                i -= 1
            if i < stop:
                before.append((i, stop))
        words = before[::-1]
        quiet, last = 0, own
        for w in WORD.finditer(text, own):
            words.append(w.span())
            last = w.end()
            quiet = 0 if SEED.search(w.group()) else quiet + 1
            if quiet == CONTEXT:
                break
        if out and out[-1] and words and words[0][0] <= done and text[done : words[0][0]].strip() == "" and done:
            out[-1] += words
        else:
            out.append(words)
        done = last
        m = SEED.search(text, last) if last < n else None
    return out


def crf_spans(texts: list[str], taken: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the items the field finds outside the spans of the patterns."""
    emit, move = model()
    owner, places, emission, known = [], [], [], {}
    for i, text in enumerate(texts):
        for seq in sequences(text):
            words = [text[a:b] for a, b in seq]
            fs = features(words)
            rows = []
            for f in fs:
                key = tuple(f)
                if key not in known:
                    known[key] = emit[f].sum(0)
                rows.append(known[key])
            owner.append(i)
            places.append(seq)
            emission.append(np.array(rows))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, seq, path in zip(owner, places, viterbi(emission, move)):
        items: list[list[int]] = []
        for (a, b), label in zip(seq, path):
            name = LABELS[label]
            if name == "O":
                continue
            if name.startswith("+") and items:
                items[-1][2] = b
            else:
                items.append([a, KINDS.index(name.lstrip("+")), b])
        for a, kind, b in items:
            inner = texts[i][a:b]
            a += len(inner) - len(inner.lstrip(EDGE_LEFT))
            b -= len(inner) - len(inner.rstrip(EDGE_RIGHT)) if b > a else 0
            if a < b and not any(x < b and a < y for x, _, y in taken[i]):
                out[i].append((a, kind, b))
    return out


# --- the fixed patterns ---

EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns, in order."""
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        # the longest run of name characters before the @, after the last match
        start = at
        while start > free and text[start - 1] in EMAIL_LEFT:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if SEED.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Spans of the patterns, and spans the field adds, for each text."""
    base = [base_spans(t) for t in texts]
    return base, crf_spans(texts, base)


def pii(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus counts of the patterns, a digest of their spans and all spans of every whole text.

    Spans are ``kind:start:end`` in code points, end exclusive. NULL is an empty text: no spans, counts
    0, the digest of nothing. Each row is judged alone, so repeated rows and ties give equal rows; an
    empty table gives an empty result; other columns are not read.
    """

    def work(texts: list[str]) -> list[list]:
        base, more = find(texts)
        counts = [[sum(k == j for _, k, _ in s) for s in base] for j in range(len(KINDS))]
        digests = [hashlib.sha256(listed(s).encode()).hexdigest() for s in base]
        return [*counts, digests, [listed(sorted(a + b)) for a, b in zip(base, more)]]

    fields = [(f"n_{k}", "long") for k in KINDS] + [("base_sha256", "string"), ("spans", "string")]
    return map_texts(docs, text, fields, work, keep)


def mask(docs: DataFrame, *, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The same rows and columns with every span replaced by ``[KIND]`` and the size column counted anew.

    A NULL text stays NULL; a text without personal data is not changed. Spans that touch or overlap
    are replaced together under the name of the first.
    """

    def work(texts: list[str]) -> list[list]:
        base, more = find(texts)
        out = []
        for t, a, b in zip(texts, base, more):
            parts, at = [], 0
            for start, kind, end in sorted(a + b):
                if start >= at:
                    parts += [t[at:start], f"[{KINDS[kind].upper()}]"]
                at = max(at, end)
            out.append("".join([*parts, t[at:]]) if parts else t)
        return [out]

    plain, named, back = shielded(docs)
    made = map_texts(plain, named[text], [("masked", "string")], work, plain.columns)
    new = F.when(F.col(named[text]).isNotNull(), F.col("masked"))
    changed = {named[text]: new}
    if size in named:
        changed[named[size]] = F.coalesce(F.length(new), F.col(named[size])).cast(docs.schema[size].dataType)
    return back(made.withColumns(changed))
