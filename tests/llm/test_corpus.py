"""Operators that look at the whole corpus, against brute force, planted cases and held-out accuracy."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import xxhash
from llm_helpers import DOCS, ODD, PROSE, SMALL, nothing, odd, rows
from pyspark.sql import functions as F

from fleetlake.llm import components, decontaminate, lm_score, mixing, quality_classifier, repeats, simhash

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


def held(doc_id, parts):
    return doc_id is not None and crc32(str(doc_id).encode()) % parts == 2


def table(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", (sources or ["s"] * len(texts))[i], None) for i, t in enumerate(texts)], DOCS)


# --- repeats ---


def repeated_bytes(raw, size):
    seen = Counter(r[i : i + size] for r in raw for i in range(len(r) - size + 1))
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                gone[i : i + size] = True
        yield r, gone


def naive_repeats(texts, size, least):
    raw = [(t or "").encode() for t in texts]
    out = []
    for (r, gone), (_, short) in zip(repeated_bytes(raw, size), repeated_bytes(raw, least)):
        starts = lambda g: np.flatnonzero(g[:-1] & ~np.concatenate([[False], g[:-2]])[: len(g) - 1])
        longest = max((int(np.argmin(short[a:])) for a in starts(short)), default=0)
        out.append((len(r), int(gone.sum()), len(starts(gone)), hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest(), len(starts(short)), longest))
    return out


def tangled(n, seed):
    """Texts made of few shared pieces, cut, repeated and altered."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(20, 150))) for _ in range(12)] + ["ab" * 60, "xyz" * 50, "q" * 130]
    out = []
    for _ in range(n):
        text = "".join((p := rng.choice(pieces))[rng.randint(0, 30) :] if rng.random() < 0.5 else rng.choice(pieces) for _ in range(rng.randint(1, 5)))
        out.append(text)
    return out


@pytest.mark.parametrize("group,least", [(20_000, 40), (2, 40), (20_000, 64)])
def test_repeats_match_brute_force_on_tangled_texts(spark, group, least):
    texts = tangled(150, 3) + [None, "", "short"]
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(table(spark, texts), size=64, least=least, group=group).collect()}
    want = naive_repeats(texts, 64, least)
    assert [got[i] for i in range(len(texts))] == want


def test_repeats_match_brute_force_on_documents(spark, docs):
    some = docs.collect()
    want = {r["doc_id"]: w for r, w in zip(some, naive_repeats([r["text"] for r in some], 400, 200))}
    assert {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs).collect()} == want


def test_interval_tree_matches_all_pairs():
    rng = random.Random(8)
    for _ in range(300):
        members = sorted({(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 8))), bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 8)))) for _ in range(rng.randint(1, 12))}, key=lambda m: (m[1], m[0]))
        want = {}
        for i, (a, b) in enumerate(members):
            both = [(repeats.common(a, c), repeats.common(b, d)) for j, (c, d) in enumerate(members) if j != i]
            both = [(x, y) for x, y in both if x + y >= 6]
            if both:
                want[i] = (max(x for x, _ in both), max(y for _, y in both))
        got = repeats.extents(members, 6, 4)
        assert {i: e for (i, wide), e in got.items() if wide} == want
        assert {(i, True): e for (i, wide), e in repeats.extents(members, 4).items() if wide} == {(i, True): e for (i, wide), e in got.items() if not wide}


def test_many_copies_of_one_text_among_near_copies(spark):
    """Copies meet before their bytes are shuffled: an anchor gets one row for each kind of context."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    hot = " ".join(words)
    near = [" ".join([*words[:150], f"x{i}", *words[151:]]) for i in range(6)]
    texts = [hot] * 1500 + near + [" ".join(rng.choice(words) for _ in range(90)) + " " + " ".join(words[40:100])]
    df = table(spark, texts).repartition(8)
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(df).collect()}
    want = naive_repeats([hot, hot, *near, texts[-1]], 400, 200)
    assert {got[i] for i in range(1500)} == {want[0]}
    assert [got[i] for i in range(1500, len(texts))] == want[2:]


def test_a_text_longer_than_a_segment(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    rng = random.Random(1)
    raw = ["".join(rng.choice("abcdef") for _ in range(3000)).encode()]
    cut = repeats.anchors_of(raw, 100)
    monkeypatch.setattr(repeats, "SEGMENT", 1 << 20)
    whole = repeats.anchors_of(raw, 100)
    assert cut[0][0].tolist() == whole[0][0].tolist()
    assert (cut[2][0] == whole[2][0]).all()


# --- SimHash ---


def naive_print(text, width=3):
    words = (text or "").encode().lower().split()
    made = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(ids, prints, bits=3):
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(ids))]


def test_simhash_matches_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 40)
    monkeypatch.setattr(simhash, "LEAF", 8)
    some = docs.collect()
    near = [(1000 + i, r["text"] + f" tail{i}", "en", "s", None) for i, r in enumerate(some[:40])]
    df = docs.unionByName(spark.createDataFrame(near, DOCS))
    ids, texts = zip(*[(r["doc_id"], r["text"]) for r in some], *[(d, t) for d, t, *_ in near])
    prints = [naive_print(t) for t in texts]
    want = {d: (f"{p:016x}", c) for d, p, c in zip(ids, prints, naive_components(ids, prints))}
    assert {r[0]: (r[1], r[2]) for r in simhash.simhash_components(df).collect()} == want


def test_trees_find_every_close_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 60)
    monkeypatch.setattr(simhash, "LEAF", 6)
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    made = {int(c) for c in centres}
    for c in centres:  # chains and balls around centres, one of them large
        for _ in range(400 if c == centres[0] else 8):
            flips = rng.integers(0, 64, rng.integers(1, 5))
            made.add(int(c) ^ sum(1 << int(b) for b in set(flips.tolist())))
    values = sorted(made)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {r[0]: r[1] for r in simhash.classes(df).collect()}
    want = naive_components(list(range(len(values))), values)
    assert len(set(got.values())) == len(set(want))
    assert all(len({got[signed[i]] for i in range(len(want)) if want[i] == c}) == 1 for c in set(want))


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(-5, 60), (200, 200)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {-5}
    assert {got[i] for i in range(100, 140)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_each_group(spark, docs):
    df = docs.unionByName(docs).unionByName(odd(spark).withColumn("doc_id", F.col("doc_id") + 10_000))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    comps = simhash.simhash_components(df.where("doc_id is not null"))
    assert kept.where("doc_id is not null").count() == comps.select("component_id").distinct().count()
    assert set(r[0] for r in comps.select("component_id").distinct().collect()) == {r[0] for r in kept.where("doc_id is not null").select("doc_id").collect()}


# --- language model ---


def test_base_scores_match_brute_force(spark, docs):
    df = docs.unionByName(odd(spark))
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    some = df.collect()
    c = Counter(w for r in some if not held(r["doc_id"], 7) for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    want = sorted(((r["doc_id"], held(r["doc_id"], 7), len(tokens(r["text"])), sum(c[w] > 0 for w in tokens(r["text"])), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(r["text"])), 4)) for r in some), key=repr)
    got = lm_score.lm_score(df, words=50, endings=8).collect()
    assert sorted((tuple(r)[:5] + (round(r["base_score"], 4),) for r in got), key=repr) == want


def test_blocks_do_not_change_scores(spark, docs, monkeypatch):
    whole = {r["doc_id"]: r["score"] for r in lm_score.lm_score(docs, words=100, endings=8).collect()}
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 3_000)
    cut = {r["doc_id"]: r["score"] for r in lm_score.lm_score(docs, words=100, endings=8).collect()}
    assert whole == pytest.approx(cut)


def test_ids_keep_their_type(spark, docs):
    whole = {str(r["doc_id"]): tuple(r)[1:] for r in lm_score.lm_score(docs, words=100, endings=8).collect()}
    named = lm_score.lm_score(docs.withColumn("doc_id", F.col("doc_id").cast("string")), words=100, endings=8)
    assert named.schema["doc_id"].dataType.simpleString() == "string"
    got = {r["doc_id"]: tuple(r)[1:] for r in named.collect()}
    assert got.keys() == whole.keys()
    assert all(got[k] == pytest.approx(whole[k]) for k in whole)
    other = docs.withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id")))
    assert lm_score.lm_score(other, words=100, endings=8).where("doc_id like 'doc-%'").count() == docs.count()


def test_model_is_normalised_and_beats_unigrams(spark):
    rng = np.random.default_rng(0)
    counts = rng.poisson(rng.gamma(0.3, 20, (40, 1)) * rng.dirichlet(np.full(40, 0.1), 40) * 40)
    log_p = lm_score.train(counts, dims=12, steps=300)
    assert (10.0**log_p.astype(np.float64)).sum(1) == pytest.approx(np.ones(40), abs=1e-4)
    share = (counts.sum(0) + 1) / (counts.sum() + 40)
    assert (counts * log_p).sum() > (counts * np.log10(share)).sum() * 0.95
    got = lm_score.lm_score(spark.read.parquet(f"{MIDDLE}/documents.parquet")).where("held_out").groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]


# --- mixing ---


def test_readings_are_placed_one_by_one(spark, docs):
    mixed = mixing.mix(docs, keep=["lang"])
    once = {r["doc_id"]: r for r in mixed.collect()}
    got = mixing.readings(mixed).collect()
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)
    assert any(r["reading"] > 0 for r in got)
    words, places = Counter(), {}
    for r in got:
        words[r["doc_id"]] += r["words"]
        places.setdefault(r["doc_id"], []).append((r["reading"], r["position"]))
        assert 0 < r["words"] <= r["size"] and r["lang"] == once[r["doc_id"]]["lang"]
    assert words == {k: r["taken"] for k, r in once.items() if r["taken"]}
    assert {k: [p for _, p in sorted(v)] for k, v in places.items()} == {k: list(r["positions"]) for k, r in once.items() if r["taken"]}
    assert mixing.readings(mixing.mix(docs.limit(0))).count() == 0


def water(sizes, weights, most=3):
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i] / w
            break
        for i in over:
            target[i] = float(most * sizes[i])
            left -= target[i]
            open_.discard(i)
    return target


def test_mix_meets_its_targets(spark, docs):
    df = docs.unionByName(odd(spark))
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert (r["taken"] > 0) == bool(r["positions"])
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = water([sizes[s] for s in names], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])
    assert [targets[s] for s in names] == pytest.approx(want)
    assert all(abs(taken[s] - targets[s]) < 1.001 for s in names)
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    places = [r["position"] for r in got if r["position"] is not None]
    assert places == sorted(places)
    assert rows(mixing.mix(df)) == rows(mixing.mix(df.repartition(5)))


def test_curriculum_follows_its_schedule(spark):
    texts = ["w " * 10] * 3000
    got = mixing.mix(table(spark, texts), schedules=[(2.0, 0.0)]).where("taken > 0").collect()
    early = sum(r["position"] < 0.5 for r in got) / len(got)
    assert early == pytest.approx(0.75, abs=0.01)  # the integral of 2 - 2t up to one half


# --- decontamination ---


def edits(a, b):
    """Least edits between ``a`` and a part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(6)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(2))
        assert decontaminate.distance_within(a, b)[0] == edits(a, b)


def altered(text, rate, rng):
    out = list(text)
    for _ in range(int(rate * len(out))):
        k, what = rng.randrange(len(out)), rng.random()
        if what < 0.4:
            out[k] = rng.choice("abcdefgh ")
        elif what < 0.7:
            out.pop(k)
        else:
            out.insert(k, rng.choice("etaoin"))
    return "".join(out)


def test_planted_items_are_found_and_clean_documents_left(spark, docs, benchmark):
    rng = random.Random(3)
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    clean = [r["text"] for r in docs.collect() if not any(t[:30].lower() in r["text"].lower() or t[-30:].lower() in r["text"].lower() for _, t in items)]
    plant = [(i, rate) for rate in (0.0, 0.03, 0.08) for i, _ in items]
    texts = [clean[k % len(clean)][:600] + "\n" + altered(dict(items)[i], rate, rng).replace(" ", "  ").upper() + " " + clean[(k + 1) % len(clean)][:300] for k, (i, rate) in enumerate(plant)]
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.decontaminate(table(spark, texts + clean), benchmark).collect()}
    hit = defaultdict(list)
    for k, (i, rate) in enumerate(plant):
        hit[rate].append((k, i) in got)
    assert all(hit[0.0]) and np.mean(hit[0.03]) >= 0.97 and np.mean(hit[0.08]) >= 0.9
    assert not [k for k in got if k[0] >= len(texts)]
    for (doc, item), r in got.items():
        plain = lambda t: decontaminate.normalised(t).decode()
        part = plain(texts[doc][r["start"] : r["end"]])
        assert r["distance"] <= 0.2 * len(dict(items)[item])
        assert edits(plain(dict(items)[item]), part) == r["distance"]


def test_recall_up_to_the_similarity_limit(benchmark):
    rng = random.Random(12)
    items = sorted((r["item_id"], decontaminate.normalised(r["text"]).decode()) for r in benchmark.collect())
    repeats = decontaminate.repeats_for(items, 0.8, 0.9)
    assert decontaminate.repeats_for(items, 1.0, 0.9) < repeats < decontaminate.REPEATS
    index = decontaminate.Index(items, range(repeats))
    for rate, least in ((0.15, 0.93), (0.2, 0.85)):
        hits = [i in h for _ in range(5) for (i, _), h in zip(items, index.matches(["and so on\n" + altered(t, rate, rng) + " then" for _, t in items], 0.8))]
        assert np.mean(hits) >= least, (rate, np.mean(hits))


def test_matches_an_exhaustive_search(spark, docs, benchmark):
    rng = random.Random(21)
    items = [(r["item_id"], decontaminate.normalised(r["text"]).decode()) for r in benchmark.collect()]
    items = [(i, t) for i, t in items if len(t) >= 128]
    plain = [decontaminate.normalised(r["text"]).decode()[:400] for r in docs.limit(40).collect()]
    texts = [plain[k % 40] + " " + altered(items[k % len(items)][1], 0.24 * k / 150, rng) + " " + plain[(k + 7) % 40] for k in range(150)] + plain
    distance = {(d, i): decontaminate.distance_within(t, decontaminate.normalised(x).decode())[0] for d, x in enumerate(texts) for i, t in items}
    truth = {k for k, n in distance.items() if n <= int(0.2 * len(dict(items)[k[1]]) + 1e-9)}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.decontaminate(table(spark, texts), benchmark).collect() if r["item_id"] in dict(items)}
    assert set(got) <= truth and len(got) >= 0.95 * len(truth) > 100
    wrong = {k: (n, distance[k]) for k, n in got.items() if distance[k] != n}
    assert not wrong


def test_texts_without_blanks_and_ids_of_any_kind(spark):
    rng = random.Random(8)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    thai = "".join(chr(rng.randrange(0xE01, 0xE2F)) for _ in range(12))
    dashed = "one-run-of-many-words-joined-by-dashes-and-cut-nowhere-else-at-all"
    items = [("zh", chinese[150:202]), ("th", thai), ("dash", dashed), (None, "an item that has no id of its own but is still an item")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    changed = chinese[:150] + chinese[150:160] + "的" + chinese[161:190] + chinese[192:]
    texts = [chinese, "xx" + dashed + ".", "see " + "x" * 9 + thai + "yy", "so: " + items[3][1], chinese[202:], "plain words " * 9, changed]
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.decontaminate(table(spark, texts), bench).collect()}
    assert got == {(0, "zh", 0), (1, "dash", 0), (2, "th", 0), (6, "zh", 3)}
    assert {r["doc_id"] for r in decontaminate.clean(table(spark, texts), bench).collect()} == {4, 5}


def test_unreachable_recall_is_said():
    with pytest.warns(UserWarning, match="walks find"):
        assert decontaminate.repeats_for([(0, "abcde"), (1, "vwxyz")], 0.8, 1.0) == decontaminate.REPEATS


def test_clean_keeps_rows_and_blocks_agree(spark, docs, benchmark, monkeypatch):
    bad = {r[0] for r in decontaminate.decontaminate(docs, benchmark).select("doc_id").collect()}
    kept = decontaminate.clean(docs, benchmark)
    assert bad and kept.columns == docs.columns
    assert rows(kept) == sorted((tuple(r) for r in docs.collect() if r["doc_id"] not in bad), key=repr)
    one = rows(decontaminate.decontaminate(docs, benchmark))
    monkeypatch.setattr(decontaminate, "ITEMS", 15)
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (15,))
    assert rows(decontaminate.decontaminate(docs, benchmark)) == one


def test_odd_items(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "the and of"), (3, " \n "), (4, PROSE), (4, PROSE), (5, "zq")], "item_id long, text string")
    got = decontaminate.decontaminate(odd(spark), items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 4), (2, 4), (None, 4)}
    assert got.count() == 4
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


# --- classifier ---


def test_classifier_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality_classifier.quality_classifier(docs, labels)
    assert got.count() == docs.count()
    known = got.where("held_out").join(labels, "doc_id").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in known])
    kept = np.mean([r["predicted"] for r in known if r["quality"] == 1])
    gone = np.mean([1 - r["predicted"] for r in known if r["quality"] == 0])
    assert right >= 0.97 and kept >= 0.98 and gone >= 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in known)
    assert all(r["held_out"] == held(r["doc_id"], 4) for r in got.limit(500).collect())


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 400)
    found = [np.sort(rng.choice(np.arange(0, 40) if y else np.arange(30, 70), 8, replace=False)) for y in labels]
    ratios = quality_classifier.log_count_ratios(found, labels)
    model = quality_classifier.train(found, labels.tolist())
    assert ratios[:30].max() > 0 > ratios[40:70].min()
    assert np.mean([(model.margin(f) > 0) == y for f, y in zip(found, labels)]) > 0.97


def test_classifier_without_both_classes(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality_classifier(docs, labels)
    assert got.count() == docs.count()
    assert got.select("score").distinct().count() == 1
    assert quality_classifier.quality_classifier(docs, labels.limit(0)).count() == docs.count()


# --- odd tables, for all ---


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows_and_empty_tables(spark, benchmark, extra):
    df = odd(spark, extra)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    calls = [repeats.remove_repeats, simhash.simhash_components, lm_score.lm_score, mixing.mix, lambda d: quality_classifier.quality_classifier(d, labels)]
    for call in calls:
        got = call(df)
        assert got.count() == len(ODD)
        assert got.where("doc_id is null").count() == 2
        assert call(nothing(spark)).count() == 0
    assert decontaminate.decontaminate(df, benchmark).count() == 0
    for stage in (simhash.keep_one, lambda d: decontaminate.clean(d, benchmark)):
        assert stage(df).columns == df.columns
        assert stage(nothing(spark)).count() == 0
    twice = {r["doc_id"]: r for r in repeats.remove_repeats(df).collect()}
    assert twice[6]["n_removed"] == 50_000  # a run of one letter repeats inside itself
    assert twice[3]["n_bytes"] == 0
