"""Language-model scores: exact smoothed unigrams, and a log-bilinear model over word classes.

Texts are cut into blocks of 16 MB; a block lists its documents' tokens as numbers in its own
dictionary. Only dictionaries meet the corpus-wide counts, one row per word and block, so the shuffles
carry far fewer rows than there are words in documents. Counts are summed in the tasks first and joined
back to the dictionaries, so a word of every block is split like any other hot key of a join.

The model: the ``WORDS`` most frequent tokens are classes of their own, every other token falls into one
of ``ENDINGS`` classes by its last two bytes. P(token | previous) = P(class | previous class) times
P(token | class); the second factor is 1 for frequent tokens and add-one smoothed counts otherwise, so
probabilities add up to one. The first is log-bilinear: context vector times class vector plus bias.
Its counts of neighbouring classes are a bounded table that Spark sums over all training text; from
it numpy fits vectors by noise-contrastive estimation, taking the noise's expectation exactly. Batched
matrix products then give the normalised log-probabilities of all pairs of classes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import held_out
from fleetlake.session import materialise

FOLDS = 7
BLOCK_BYTES = 16_000_000
BATCH_TOKENS = 1_000_000
WORDS, ENDINGS = 1_000, 64
DIMENSIONS, NOISE, STEPS = 24, 20, 120
END = b""  # no word is empty

def pack(numbers: np.ndarray) -> bytes:
    """Token numbers in fewer bytes: they are written, shuffled and read again."""
    return zlib.compress(numbers.tobytes(), 1)


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of documents (doc_id, text, held_out): a row per document with its token numbers, then a row per token of the block.

    Document rows: block, id (doc_id, of its own type), held, codes. Token rows: block, code (its number), token, n (its training count).
    """
    names = ["block", "id", "held", "codes", "code", "token", "n"]
    types = [pa.int64(), pa.null(), pa.bool_(), pa.binary(), pa.int32(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made, ids, held, codes, known, size = 0, [], [], [], {}, 0

        def rows() -> Iterator[pa.RecordBatch]:
            block, docs, tokens = part << 32 | made, len(ids), len(known)
            learn = [c for c, h in zip(codes, held) if not h]
            counts = np.bincount(np.concatenate(learn) if learn else np.zeros(0, np.int32), minlength=tokens)
            row = [np.full(docs, block), ids, held, [pack(c) for c in codes], [None] * docs, [None] * docs, [None] * docs]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)
            row = [np.full(tokens, block), [None] * tokens, [None] * tokens, [None] * tokens, np.arange(tokens), list(known), counts]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            types[1] = batch.schema.field(0).type
            texts = batch.column(1)
            for i, (doc, out) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                words = (texts[i].as_py() or "").encode().lower().split()
                words.append(END)
                number = known.setdefault
                codes.append(np.array([number(w, len(known)) for w in words], np.int32))
                ids.append(doc)
                held.append(out)
                size += sum(map(len, words)) + len(words)
                if size >= BLOCK_BYTES:
                    yield from rows()
                    made, ids, held, codes, known, size = made + 1, [], [], [], {}, 0
        if ids:
            yield from rows()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, f"block long, id {kind}, held boolean, codes binary, code int, token binary, n long")


def with_classes(counted: DataFrame, words: int, endings: int) -> DataFrame:
    """Adds ``cls`` to tokens with their training counts ``c``: frequent ones get their rank, others a class by ending."""
    top = counted.where("c > 0").orderBy(F.col("c").desc(), "token").limit(words).select("token").collect()
    # at most ``words`` rows
    table = counted.sparkSession.createDataFrame([(bytes(r[0]), i) for i, r in enumerate(top)], "token binary, rank int")
    ending = F.lit(words) + F.pmod(F.crc32(F.expr("substring(token, -2, 2)")), F.lit(endings)).cast("int")
    return counted.join(F.broadcast(table), "token", "left").withColumn("cls", F.coalesce("rank", ending)).drop("rank")


# --- the log-bilinear model ---


def train(pairs: np.ndarray, dims: int = DIMENSIONS, noise: int = NOISE, steps: int = STEPS, rate: float = 0.05) -> np.ndarray:
    """log10 P(class | previous class) from counts of pairs (previous x class), by noise-contrastive estimation.

    A pair from the text has to be told from ``noise`` classes drawn from the class shares. The draw is
    not made: its expectation enters the gradient. Adam steps from a fixed start.
    """
    n = len(pairs)
    if n == 0:
        return np.zeros((0, 0), np.float32)
    pairs = pairs.astype(np.float32)
    total = max(float(pairs.sum()), 1.0)
    share = (pairs.sum(0) + 1) / (total + n)
    base = np.log(share).astype(np.float32)
    data = pairs / np.float32(total)
    drawn = np.float32(noise) * data.sum(1, keepdims=True) * share.astype(np.float32)
    log_noise = np.log(np.float32(noise)) + base
    rng = np.random.default_rng(11)
    context = (rng.standard_normal((n, dims)) * 0.1).astype(np.float32)
    target = (rng.standard_normal((n, dims)) * 0.1).astype(np.float32)
    weights = [context, target, base.copy()]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        odds = weights[0] @ weights[1].T + weights[2] - log_noise
        real = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        slope = data * (1 - real) - drawn * real
        # rare classes get steps as large as frequent ones: Adam divides by each weight's own scale
        grads = [slope @ weights[1], slope.T @ weights[0], slope.sum(0)]
        for w, g, (m, v) in zip(weights, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-12)
    return normalised(*weights)


def normalised(context: np.ndarray, target: np.ndarray, bias: np.ndarray, batch: int = 256) -> np.ndarray:
    """log10 of the softmax over classes, for all contexts, in batches of matrix products."""
    out = np.empty((len(context), len(target)), np.float32)
    for at in range(0, len(context), batch):
        logits = (context[at : at + batch] @ target.T + bias).astype(np.float64)
        top = logits.max(1, keepdims=True)
        out[at : at + batch] = (logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True))) / np.log(10)
    return out


def lm_score(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", folds: int = FOLDS, words: int = WORDS, endings: int = ENDINGS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Learns from the documents that are not held out. Tokens are words in lower case (A-Z) and one end
    per text; NULL is the empty text: its end alone. ``base_score`` is the add-one unigram log10
    probability with exact corpus counts, ``score`` the model's. Ids keep their type, text included; NULL
    ids learn and score like others; repeated rows stay; with no training text every token is unseen. An empty table gives an empty
    result. Other columns are not read.
    """
    classes = words + endings
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), held_out(F.col(f"`{doc_id}`"), folds).alias("held_out"))
    rows = materialise(encode(own), "lm-blocks")
    entries = rows.where("token is not null").select("block", "code", "token", "n")
    counted = materialise(entries.groupBy("token").agg(F.sum("n").alias("c")), "lm-counts")
    classed = with_classes(counted, words, endings)
    seen = classed.where("c > 0").groupBy(F.greatest(F.col("cls"), F.lit(words - 1)).alias("cls")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    total, distinct = sum(r["n"] for r in seen), sum(r["v"] for r in seen)
    unseen = np.ones(endings)  # the tokens and kinds of each class of rare words, and one for any unseen
    for r in seen:
        if r["cls"] >= words:
            unseen[r["cls"] - words] += r["n"] + r["v"]

    def classify(key: tuple, docs: pa.Table, dictionary: pa.Table) -> pa.Table:
        code = dictionary.column("code").to_numpy()
        c, cls = np.zeros(len(code), np.float64), np.zeros(len(code), np.int64)
        c[code], cls[code] = dictionary.column("c").to_numpy(), dictionary.column("cls").to_numpy()
        base = np.log10((c + 1) / (total + distinct + 1))
        inner = np.where(cls >= words, np.log10((c + 1) / unseen[np.maximum(cls - words, 0)]), 0.0)
        out: list[list] = [[], [], [], [], []]
        for codes in docs.column("codes"):
            flat = np.frombuffer(zlib.decompress(codes.as_buffer()), np.int32)
            for column, value in zip(out, (len(flat), int((c[flat] > 0).sum()), base[flat].sum(), inner[flat].sum(), pack(cls[flat].astype(np.uint16)))):
                column.append(value)
        return pa.table([docs.column("id"), docs.column("held"), *[pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()))]], names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "classes"]
    by_block = rows.where("token is null").select("block", "id", "held", "codes").groupBy("block")
    dictionaries = entries.join(classed, "token").select(F.col("block").alias("of"), "code", "c", "cls").groupBy("of")
    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, inner double, classes binary"
    coded = materialise(by_block.cogroup(dictionaries).applyInArrow(classify, schema), "lm-classes")
    end_class = next((r["cls"] for r in classed.where("length(token) = 0").select("cls").collect()), words)

    def neighbours(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair numbers of tokens with what stands before them, the first of a text after an end; sizes and starts of the texts."""
        texts = [zlib.decompress(x.as_buffer()) for x in batch.column("classes")]
        now = np.frombuffer(b"".join(texts), np.uint16).astype(np.int64)
        sizes = np.array([len(t) // 2 for t in texts], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        before = np.concatenate([[end_class], now[:-1]])
        before[first] = end_class
        return before * classes + now, sizes, first

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of few enough tokens to be worked on as arrays."""
        for batch in batches:
            at, size = 0, 0
            for i, n in enumerate(batch.column("n_tokens").to_pylist()):
                if size and size + n > BATCH_TOKENS:
                    yield batch.slice(at, i - at)
                    at, size = i, 0
                size += n
            if size:
                yield batch.slice(at)

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(classes * classes, np.int64)
        for batch in parts(batches):
            pair, sizes, _ = neighbours(batch)
            learn = np.repeat(~np.array(batch.column("held_out").to_pylist(), bool), sizes)
            seen += np.bincount(pair[learn], minlength=classes * classes)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["pair", "n"])

    # a bounded table: pairs of classes
    summed = coded.select("n_tokens", "held_out", "classes").mapInArrow(pairs_of, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(classes * classes)
    pairs[summed.column("pair").to_numpy()] = summed.column("n").to_numpy()
    log_p = train(pairs.reshape(classes, classes))
    flat_p = log_p.ravel()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            pair, _, first = neighbours(batch)
            outer = np.add.reduceat(flat_p[pair].astype(np.float64), first)
            known = [batch.column(n) for n in ("doc_id", "held_out", "n_tokens", "n_known")]
            sums = [batch.column("base"), pa.array(batch.column("inner").to_numpy() + outer)]
            yield pa.RecordBatch.from_arrays([*known, pa.array(np.full(len(outer), total, np.int64)), *sums], names=result)

    result = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return coded.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
