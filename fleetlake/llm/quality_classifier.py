"""Document quality by Naive Bayes support vectors.

N-gram indicators of a text are scaled by their class log-count ratios; a linear separator is fitted
on the scaled vectors (unit length) by dual coordinate descent on the hinge loss, and a logistic curve
through the margins of a fold kept out of that fit turns margins into scores.

The n-grams: words, word shapes, pairs of shapes, pairs of a word and whether the next repeats it.
The fit reads at most ``MAX_LABELLED`` labelled rows, taken in a fixed pseudo-random order; scoring
reads every whole text once and shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import held_out, map_texts, shielded

MAX_LABELLED = 20_000
FOLDS, HELD_FOLD = 4, 2
BITS = 18
CUT = 0.7
MAX_WORDS_KNOWN = 300_000

INNER = re.compile(rb"[\x80-\xff]+|[a-z]+")
_RUN = re.compile(rb"(.)\1+")
_known: dict[bytes, tuple[int, bytes]] = {}


def describe(word: bytes) -> tuple[int, bytes]:
    """(number of the word's own feature, its shape): letters become a, capitals A, digits 9, runs one sign."""
    shape = re.sub(rb"[A-Z]+", b"A", re.sub(rb"[0-9]+", b"9", INNER.sub(b"a", word)))
    out = (crc32(word) % (1 << BITS), _RUN.sub(rb"\1\1", shape))
    if len(word) <= 64:  # longer ones are rare: described anew each time
        if len(_known) > MAX_WORDS_KNOWN:
            _known.clear()
        _known[word] = out
    return out


def indicators(text: str) -> np.ndarray:
    """Sorted numbers of the n-grams a text holds."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.int64)
    known = _known
    told = [known.get(w) or describe(w) for w in words]
    own = {t[0] for t in told}
    shapes = [t[1] for t in told]
    grams = {b"1" + s for s in set(shapes)}
    grams |= {b"2" + a + b" " + b for a, b in set(pairwise(shapes))}
    grams |= {b"3" + b"%d" % (a == b) for a, b in pairwise(words)}
    # how much of the text repeats itself, in steps of a tenth
    grams.add(b"4%d" % (10 * len(own) // len(words)))
    own |= {crc32(g) % (1 << BITS) for g in grams}
    return np.array(sorted(own), np.int64)


@dataclass
class Model:
    weights: np.ndarray  # separator times log-count ratio
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        length = float(np.sqrt((self.ratios[found] ** 2).sum())) or 1.0
        return float(self.weights[found].sum()) / length + self.bias

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(indicators(text)) + self.shift, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << BITS))
    for found, y in zip(rows, labels):
        counts[int(y), found] += 1
    p = counts / counts.sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0])


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, c: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Hinge-loss separator: one dual variable per row, each solved in turn; classes weigh alike."""
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    values = []
    for found in rows:
        v = ratios[found]
        values.append(v / (np.sqrt((v * v).sum()) or 1.0))
    share = np.array([max((labels == k).mean(), 1e-9) for k in (0, 1)])
    most = c * 0.5 / share[labels]
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            found, v, y = rows[i], values[i], 2 * int(labels[i]) - 1
            slack = y * (w[found] @ v + bias) - 1
            new = min(max(alpha[i] - slack / (v @ v + 1), 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                alpha[i] = new
                w[found] += step * v
                bias += step
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve through (margin, label), by Newton steps, with softened labels."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((goal - p) * margins).sum() - 1e-3 * a, (goal - p).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def train(rows: list[np.ndarray], labels: Sequence[int]) -> Model:
    """Four fifths fit the separator, one fifth the curve. Without both classes every score is the share of ones."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2 or len(rows) < 10:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
    kept = np.arange(len(rows)) % 5 == 4
    fit = [r for r, k in zip(rows, kept) if not k]
    ratios = log_count_ratios(fit, y[~kept])
    w, bias = dual_coordinate_descent(fit, y[~kept], ratios)
    model = Model(w * ratios, ratios, bias, 1.0, 0.0)
    model.slope, model.shift = logistic(np.array([model.margin(r) for r, k in zip(rows, kept) if k]), y[kept])
    return model


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from at most ``max_labelled`` labelled documents outside the held-out fold.

    Rows without a label or id are not learned from; of several labels of an id the smallest counts, of
    several texts the one with the smallest hash.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    known = known.where(~held_out(F.col("_id"), FOLDS)).groupBy("_id").agg(F.min("_y").alias("_y"))
    # at most max_labelled rows of two numbers: small enough to send to every task
    chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    own = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(chosen, "_id")
    found = map_texts(own, "_text", [("_found", "binary")], lambda texts: [[indicators(t).astype(np.int32).tobytes() for t in texts]], ["_id", "_y"])
    one = found.groupBy("_id").agg(F.min(F.struct(F.xxhash64("_found").alias("h"), "_y", "_found")).alias("r"))
    rows = one.select("_id", "r._y", "r._found").toArrow().sort_by("_id")
    order = sorted(range(rows.num_rows), key=lambda i: crc32(str(rows["_id"][i].as_py()).encode()))
    ys, raw = rows["_y"].to_pylist(), rows["_found"]
    return train([np.frombuffer(raw[i].as_py(), np.int32).astype(np.int64) for i in order], [ys[i] for i in order])


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: Sequence[str] = ("doc_id",), cut: float = CUT) -> DataFrame:
    """``keep`` plus score (0 to 1, higher: better) and predicted (1 from ``cut`` on) of every whole text.

    A NULL or empty text has no n-grams and gets the score of the separator's bias. Repeated rows stay
    and score alike; an empty table gives an empty result; only the text decides.
    """

    def work(texts: list[str]) -> list[list]:
        return [[model.score(t) for t in texts]]

    out = map_texts(docs, text, [("score", "double")], work, [k for k in keep if k != "predicted"])
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def accepted(docs: DataFrame, model: Model, *, text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows and columns of ``docs`` whose text scores ``cut`` or more."""
    plain, named, back = shielded(docs)
    return back(score(plain, model, text=named[text], keep=plain.columns, cut=cut).where("predicted = 1"))


def quality_classifier(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; see ``fit`` and ``score``."""
    model = fit(docs, labels, text=text, doc_id=doc_id, label=label, max_labelled=max_labelled)
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`"), FOLDS).alias("held_out"), F.col(f"`{text}`").alias("text"))
    return score(own, model, keep=("doc_id", "held_out"))
