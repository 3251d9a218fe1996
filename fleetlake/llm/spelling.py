"""Spelling variants: words one edit apart, found with an index of variable-length grams.

Words are written between two marks. The gram dictionary holds all grams of ``SHORTEST`` characters and
grows a gram by a character where it is frequent (over 1 / ``SHARE`` of all places), up to
``LONGEST``; what grows under a rare gram is pruned. A word has one gram at each place: the longest of the
dictionary. Which one depends on the gram's own characters only, so an edit elsewhere leaves it as it is.

Affected grams: one edit touches at most one of several grams that do not overlap. Of three such grams a near
word holds at least two, at the same places before the edit and moved by the difference in length after
it. So the lists to merge are those of pairs of grams, and a word needs three: without its first, second or
third gram. Each word picks the three grams whose pairs are rarest by the dictionary's counts. The index
holds every pair of separate grams of every word with its places and the word's length, the lists are
merged by a join on that key, and the edit distance decides. A pair that would be met again for another
missing gram is dropped there, by looking for that gram, so each near word comes once.

Places beyond ``REACH`` are not used, which bounds the pairs of a very long word: three grams of its beginning do.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.session import materialise

SHORTEST, LONGEST = 2, 3
SHARE = 4096
REACH = 16
HELD = 200_000  # words a task counts before it hands them on
FIRST, LAST = "<", ">"
# one byte a code point: A-Z lower-cased, what belongs to no run becomes a blank
_RUN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters up to U+00FF, A-Z in lower case, one byte a code point."""
    return text.encode("latin-1", "replace").translate(_RUN).split()


def damaged(run: bytes, start: int, every: int) -> bytes:
    """The run, or without one code point if ``every`` divides its checksum. ``start`` is the checksum of what stands before it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", least_chars: int = 6, least_n: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of the words of all texts; tasks count before anything is shuffled."""
    source = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(runs(t.as_py())).items():
                    word = damaged(run, start, every)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield given()
        yield given()

    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


# --- grams ---


def gram_dictionary(words: DataFrame, share: int = SHARE) -> tuple[dict[str, int], set[str]]:
    """(number of each gram of the dictionary, the frequent grams that grow).

    Letters are those of ``runs`` and the marks, so there are at most 92**2 + 92**3 grams, whatever the words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for w in batch.column(0).to_pylist():
                p = f"{FIRST}{w}{LAST}"
                for q in range(SHORTEST, LONGEST + 1):
                    held.update(p[j : j + q] for j in range(len(p) - q + 1))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])

    counts = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    known = {r["gram"]: r["n"] for r in counts.toLocalIterator()}
    places = sum(n for g, n in known.items() if len(g) == SHORTEST)
    grows: set[str] = set()
    for q in range(SHORTEST, LONGEST):
        grows |= {g for g, n in known.items() if len(g) == q and n * share > places and (q == SHORTEST or g[:-1] in grows)}
    return {g: n for g, n in known.items() if len(g) == SHORTEST or g[:-1] in grows}, grows


def grams(marked: str, grows: set[str], reach: int) -> list[str]:
    """The gram at each place of a marked word, up to ``reach`` places."""
    out = []
    for j in range(min(len(marked) - SHORTEST + 1, reach)):
        end = j + SHORTEST
        while end < len(marked) and end - j < LONGEST and marked[j:end] in grows:
            end += 1
        out.append(marked[j:end])
    return out


def affected(own: list[str]) -> int:
    """The most grams that one edit can touch."""
    cover = Counter(i for j, g in enumerate(own) for i in range(j, j + len(g)))
    return max(cover.values(), default=0)


def chosen(own: list[str], number: dict[str, int]) -> tuple[int, int, int] | None:
    """Places of three separate grams whose pairs are rarest; None if there are no three."""
    n = [number.get(g, 1) for g in own]
    best, least = None, None
    for a in range(len(own)):
        for b in range(a + len(own[a]), len(own)):
            ab = n[a] * n[b]
            if least is not None and ab >= least:
                continue
            for c in range(b + len(own[b]), len(own)):
                cost = ab + n[a] * n[c] + n[b] * n[c]
                if least is None or cost < least:
                    best, least = (a, b, c), cost
    return best


def _key(length: int, j: int, g: str, k: int, h: str) -> str:
    return f"{length} {j} {k} {g} {h}"


def index_keys(word: str, grows: set[str], reach: int = REACH) -> list[str]:
    """The lists a word stands in: every pair of separate grams with their places. Probes look one place further."""
    own = grams(f"{FIRST}{word}{LAST}", grows, reach + 1)
    return [_key(len(word), j, g, k, own[k]) for j, g in enumerate(own) for k in range(j + len(g), len(own))]


def probe_keys(word: str, number: dict[str, int], grows: set[str], reach: int = REACH) -> list[tuple[str, int, str, int]]:
    """(list to read, place that must not hold, this gram, difference in length): grams behind the edit move with the length."""
    own = grams(f"{FIRST}{word}{LAST}", grows, reach)
    found = chosen(own, number)
    if found is None:
        raise ValueError(f"fewer than three separate grams: {word}")
    a, b, c = found
    out = []
    for d in (-1, 0, 1):
        n = len(word) + d
        out.append((_key(n, b + d, own[b], c + d, own[c]), -1, "", d))
        out.append((_key(n, a, own[a], c + d, own[c]), b + d, own[b], d))
        out.append((_key(n, a, own[a], b, own[b]), c + d, own[c], d))
    return out


def near_words(words: DataFrame, *, share: int = SHARE, reach: int = REACH) -> DataFrame:
    """(word, near, near_n): every ordered pair of words that differ by one inserted, deleted or replaced code point.

    ``words`` has word (6 code points or more) and n; it is read three times.
    """
    spark = words.sparkSession
    made = gram_dictionary(words, share)
    shared = spark.sparkContext.broadcast(made)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grows = shared.value[1]
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys, word, n = [], [], []
                for w, m in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = index_keys(w, grows, reach)
                    keys += own
                    word += [w] * len(own)
                    n += [m] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["key", "near", "near_n"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, grows = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = [(w, *p) for w in batch.column(0).slice(at, 2000).to_pylist() for p in probe_keys(w, number, grows, reach)]
                columns = [pa.array(v, t) for v, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "key", "place", "gram", "longer"])

    lists = words.select("word", "n").mapInArrow(index, "key string, near string, near_n long")
    probes = words.select("word").mapInArrow(probe, "word string, key string, place int, gram string, longer int")
    marked = F.concat(F.lit(FIRST), F.col("near"), F.lit(LAST))
    again = (F.col("place") >= 0) & (F.substring(marked, F.col("place") + 1, F.length("gram")) == F.col("gram"))
    same = F.col("longer") + F.length("word") == F.length("near")
    pairs = probes.join(lists, "key").where((F.col("word") != F.col("near")) & same & ~again & (F.levenshtein("word", "near", 1) == 1))
    return pairs.select("word", "near", "near_n")


# --- forms ---


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last word that following forms leads to.

    Each round every word jumps as far as its target did, so a chain of k forms takes about log2(k) rounds.
    """
    far = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = far.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = far.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialise(step, "spelling-roots")
        far = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return far


def spelling_variants(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", least_chars: int = 6, least_n: int = 5, every: int = 199, times: int = 5, share: int = SHARE, reach: int = REACH
) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word of the texts with the common spelling it may be a variant of.

    A word's form is its near word (one edit away) with the largest n, the smaller word of equals, if that n is at least
    ``times`` the word's own; root follows forms to the end. Words without a form are their own root. NULL
    texts have no words; a NULL id counts as the empty text; repeated rows count each time. An empty
    table gives an empty result. Other columns are not read. ``least_chars`` may not be under 6.
    """
    if least_chars < 6:
        raise ValueError("words under six code points have no three separate grams")
    words = materialise(vocabulary(docs, text=text, doc_id=doc_id, least_chars=least_chars, least_n=least_n, every=every), "spelling-words")
    near = near_words(words, share=share, reach=reach)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left")
    has = -F.col("best.less") >= times * F.col("n")
    judged = judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"))
    judged = materialise(judged, "spelling-forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql(table: str = "documents") -> str:
    """The same in DuckDB SQL: a checksum by table, one-edit pairs by the words less one code point."""
    polynomial = 0xEDB88320
    return f"""WITH RECURSIVE bits AS (SELECT b, 0 AS k, CAST(b AS BIGINT) AS c FROM range(256) r(b) UNION ALL
            SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST({polynomial} AS BIGINT)) ELSE c >> 1 END FROM bits WHERE k < 8),
        crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
        runs AS (SELECT doc_id, UNNEST(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM {table}),
        low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
        each AS (SELECT doc_id, run, COUNT(*) AS n FROM low GROUP BY doc_id, run),
        hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
            lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1]))) AS h FROM (SELECT *, hex(encode(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM each), crc),
        cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word, n FROM hashed),
        words AS MATERIALIZED (SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING SUM(n) >= 5),
        less AS MATERIALIZED (SELECT DISTINCT word, n, i, substr(word, 1, CAST(i AS BIGINT)) || substr(word, CAST(i + 2 AS BIGINT)) AS part FROM (SELECT word, n, UNNEST(range(length(word))) AS i FROM words)),
        near AS MATERIALIZED (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM less a JOIN less b USING (part, i) WHERE a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.part = b.word UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.part = b.word),
        ranked AS (SELECT word, other, m, COUNT(*) OVER (PARTITION BY word) AS n_near, ROW_NUMBER() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS place FROM near),
        judged AS MATERIALIZED (SELECT w.word, w.n, COALESCE(r.n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
        walk AS (SELECT word, word AS place FROM judged UNION ALL SELECT word, form FROM walk JOIN (SELECT word AS here, form FROM judged) ON walk.place = here WHERE form IS NOT NULL),
        last AS (SELECT walk.word, walk.place AS root FROM walk JOIN judged ON walk.place = judged.word WHERE form IS NULL)
        SELECT judged.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM judged JOIN last ON last.word = judged.word"""
