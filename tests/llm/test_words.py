"""Operators on words and pieces: spelling variants, sentence pieces, ranked search."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import ODD, SMALL, nothing, odd, rows

from fleetlake.llm import lexical_search, sentence_pieces, spelling
from fleetlake.llm.queries import vocabulary

MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- spelling variants ---


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def naive_variants(texts):
    n = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, c in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * c else None
    out = []
    for w, c in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_variants_match_brute_force_on_documents(docs):
    want = naive_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = rows(spelling.spelling_variants(docs))
    assert got == want
    assert any(r[1] for r in got) and any(r[4] > 1 for r in got)


def test_variants_of_tangled_words(spark):
    """Few letters, so that nearly all words have near words; edits at the ends; chains; long words beyond the reach."""
    rng = random.Random(11)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(120)] + ["x" * 300, "y" + "x" * 300, "x" * 299 + "z", "ab" * 40, "ab" * 40 + "a"]
    text = []
    for w in stems:
        text += [w] * rng.choice([5, 6, 30, 160, 800])
    df = spark.createDataFrame([(i, " ".join(text[i::7])) for i in range(7)], "doc_id long, text string")
    for reach in (8, 16):
        assert rows(spelling.spelling_variants(df, reach=reach, share=16)) == naive_variants([(r["doc_id"], r["text"]) for r in df.collect()])


def test_an_edit_leaves_the_grams_it_does_not_touch():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(6, 12))) for _ in range(400)]
    number = Counter(f"<{w}>"[j : j + q] for w in words for q in (2, 3) for j in range(len(w) + 3 - q))
    grows = {g for g, n in number.items() if len(g) == 2 and n > 60}
    for w in words[:100]:
        i = rng.randrange(len(w))
        for other in (w[:i] + w[i + 1 :], w[:i] + "f" + w[i:], w[:i] + "f" + w[i + 1 :]):
            own = spelling.grams(f"<{w}>", grows, 99)
            again = spelling.grams(f"<{other}>", grows, 99)
            assert sum((Counter(own) & Counter(again)).values()) >= len(own) - spelling.affected(own)
            if len(other) >= 6:
                lists = set(spelling.index_keys(other, grows))
                assert any(p[0] in lists for p in spelling.probe_keys(w, number, grows))


def test_chains_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "w30")]
    got = dict(rows(spelling.roots(spark.createDataFrame(chain, "word string, form string"))))
    assert got == {w: "w37" for w, _ in chain}


# --- sentence pieces ---


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same_as_library(texts):
    own, lib = sentence_pieces.model(MODEL), library()
    ids, counts = own.encode(texts)
    parts = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert parts == lib.encode(texts)
    assert own.decode(ids, counts) == [lib.decode(p) for p in parts]


PIECES = [" ", "  ", "\n", "\t", "a", "the", "tion", "é", "1", "...", "</s>", "<0x0A>", "\xa0", "中", "日本語", "😀", "\x00", "▁", "▁▁", "aaaa", "xxxxxxxx", "ing", "ation", "　", "﻿", "==", "----", "̊", "ab", "ba", "\r\n", " " * 15, " " * 31]


def test_pieces_match_the_library_on_odd_strings():
    rng = random.Random(12)
    own = sentence_pieces.model(MODEL)
    same_as_library(["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(4000)])
    same_as_library(["".join(rng.choice("abcdeinorst ") for _ in range(rng.randint(0, 60))) for _ in range(4000)])
    same_as_library(["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(2000)])
    same_as_library(["".join(rng.choice(own.pieces[259:]) for _ in range(rng.randint(0, 20))) for _ in range(4000)])


def test_pieces_of_long_texts_and_of_documents(docs):
    rng = random.Random(2)
    same_as_library(["x" * 50_000, " " * 50_000, "ab" * 30_000, "".join(rng.choice("qwertzuiop0123456789") for _ in range(50_000)), "中文字符" * 10_000, ""])
    same_as_library([r["text"] or "" for r in docs.collect()])


def test_words_met_again_after_forgetting(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MAX_WORDS", 5)
    for text in ("one two three four five six seven", "two four nine", "", "  one  "):
        same_as_library([text, text + " again"])


def test_any_ids_decode_like_the_library():
    rng = random.Random(4)
    lists = [[rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(3, 259) for _ in range(rng.randint(0, 12))] for _ in range(4000)]
    own, lib = sentence_pieces.model(MODEL), library()
    got = own.decode(np.array([i for x in lists for i in x]), np.array([len(x) for x in lists]))
    assert got == [lib.decode(x) for x in lists]


def test_piece_digests(spark):
    lib = library()
    for r in sentence_pieces.sentence_pieces(odd(spark), MODEL, keep=("doc_id", "text")).collect():
        ids = lib.encode(r["text"] or "", add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert [r["ids"] for r in sentence_pieces.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), MODEL).collect()] == [lib.encode("a b", add_eos=True)]


# --- ranked search ---


def naive_search(texts, items, top=10):
    terms = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    docs = [(i, terms(t)) for i, t in texts if terms(t)]
    n_docs, total = len(docs), sum(len(t) for _, t in docs)
    df = Counter(w for _, t in docs for w in set(t))
    out = []
    for item, text in items:
        found = []
        for doc, t in docs:
            tf, m = Counter(t), 100 - 90 + (90 * len(t) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in set(terms(text)) if tf[w])
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        out += [(item, i + 1, doc, -score) for i, (score, _, _, doc) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,per_part,most", [(4096, 2000, 2_000_000), (7, 3, 2_000_000), (20, 2000, 200)])
def test_search_matches_brute_force(spark, docs, shard, per_part, most):
    """Small shards close bundles early; parts and passes split the items."""
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = naive_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert rows(lexical_search.lexical_search(docs, benchmark, shard=shard, per_part=per_part, most_terms=most)) == want


def test_search_with_ties_and_few_documents(spark):
    texts = [(i, "same words here") for i in range(40, 0, -1)] + [(90, "other words"), (91, ""), (92, None), (None, "same words here"), (5, "same words here")]
    items = [(1, "WORDS same same"), (2, "other"), (3, "absent"), (4, ""), (5, None), (None, "here"), (1, "WORDS same same")]
    df, asked = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for shard in (4096, 6):
        assert rows(lexical_search.lexical_search(df, asked, shard=shard)) == naive_search(texts, items)


def test_search_with_ids_as_text(spark, docs):
    named = docs.selectExpr("concat('d', doc_id) AS name", "text AS body", "1 AS shard", "2 AS rank")
    asked = spark.read.parquet(f"{SMALL}/benchmark.parquet").selectExpr("concat('q', item_id) AS q", "text AS body", "3 AS item")
    got = lexical_search.lexical_search(named, asked, text="body", doc_id="name", item_text="body", item_id="q")
    want = naive_search([(f"d{r['doc_id']}", r["text"]) for r in docs.collect()], [(r["q"], r["body"]) for r in asked.collect()])
    assert [r[:2] + r[3:] for r in rows(got)] == [r[:2] + r[3:] for r in want]


def test_a_bundle_closes_only_when_no_other_document_can_win():
    plan = lexical_search.Plan([(0, [0, 1])], np.array([1, 60]), 100, 1000, 1, 8)
    first, second = plan.owner[0], plan.owner[1]
    assert first < second
    slots, scores, open_ = lexical_search.through(plan, first, _owner({0: [(2, 3_900_000_000)]}), 0, np.zeros(8, np.int64), None)
    assert (slots.tolist(), open_) == ([2], False)
    slots, _, open_ = lexical_search.through(plan, first, _owner({0: [(2, 1000)]}), 0, np.zeros(8, np.int64), None)
    assert (slots.tolist(), open_) == ([2], True)


def _owner(lists):
    import pyarrow as pa

    by_slot = {}
    for code, entries in lists.items():
        for slot, amount in entries:
            by_slot.setdefault(slot, []).append((code, amount))
    slots = sorted(by_slot)
    return lexical_search.Owner(np.array(slots), pa.array([[c for c, _ in by_slot[s]] for s in slots], pa.list_(pa.int32())), pa.array([[a for _, a in by_slot[s]] for s in slots], pa.list_(pa.int64())))


# --- odd and empty tables ---


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows_and_empty_tables(spark, extra):
    df, none = odd(spark, extra), nothing(spark)
    texts = [(r[0], r[1]) for r in ODD]
    items = spark.createDataFrame([(1, "lamp window"), (2, None), (None, "wörter 中文")], "item_id long, text string")
    assert rows(spelling.spelling_variants(df)) == naive_variants(texts)
    assert rows(spelling.spelling_variants(none)) == []
    assert sentence_pieces.sentence_pieces(df, MODEL).count() == len(ODD)
    assert sentence_pieces.sentence_pieces(none, MODEL).count() == 0
    assert rows(lexical_search.lexical_search(df, items)) == naive_search(texts, [(1, "lamp window"), (2, None), (None, "wörter 中文")])
    assert rows(lexical_search.lexical_search(none, items)) == []
    assert rows(lexical_search.lexical_search(df, items.limit(0))) == []
