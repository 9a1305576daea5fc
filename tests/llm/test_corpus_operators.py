"""Sharding, near duplicates, language model, decontamination, toxicity,
quality rules: against brute force on small tables, and on nulls, empty and
long texts, ties, repeats, empty tables and columns with clashing names."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm import (decontaminate, language_model, near_dup, quality, sharding, toxicity,
                          words)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "doc_id long, text string, score double, n long, node long, bucket string, sig string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def clash(spark):
    return spark.createDataFrame(
        [(1, "a b c", 1.0, 5, 9, "b", "s"), (1, "a b c", 1.0, 5, 9, "b", "s"),
         (None, None, None, None, None, None, None), (2, "", 0.0, 0, 0, "", ""),
         (3, " \n", 0.0, 0, 0, "", ""), (4, None, 0.0, 0, 0, "", "")], CLASH)


def prose(rng, n, vocab=400):
    return " ".join(f"w{min(int(rng.expovariate(0.02)), vocab)}" for _ in range(n))


# ------------------------------------------------------------ sharding

def greedy(sizes, n):
    loads, got = [0] * n, [0] * n
    for s in sizes:
        i = loads.index(min(loads))
        loads[i] += s
        got[i] += 1
    return loads


def test_schedule_is_longest_processing_time_first():
    rng = random.Random(1)
    for _ in range(100):
        sizes = sorted((rng.choice([1, 3, 50, 700, rng.randint(1, 5000)])
                        for _ in range(rng.randint(1, 300))), reverse=True)
        n = rng.randint(1, 9)
        count = Counter(sizes)
        quotas = sharding.schedule([(s, c, s * c) for s, c in count.items()], n)
        loads = [sum(s * q[i] for s, q in quotas.items()) for i in range(n)]
        assert sorted(loads) == sorted(greedy(sizes, n))
        assert all(sum(q) == count[s] for s, q in quotas.items())
    assert sharding.schedule([(1, 10**12, 10**12)], 8)[1] == [125 * 10**9] * 8


def test_shards_keep_equal_texts_together_and_slots_gapless(spark):
    rng = random.Random(2)
    rows = [(i, "hot text" if i % 3 == 0 else prose(rng, rng.randint(1, 60))) for i in range(900)]
    got = sharding.shard_documents(docs(spark, rows), 8).collect()
    text = dict(rows)
    assert len(got) == 900
    shard_of, slots, loads = {}, {}, Counter()
    for r in got:
        t = text[r["doc_id"]]
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        assert shard_of.setdefault(t, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= 20
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_shard_edge_rows(spark):
    got = sharding.shard_documents(clash(spark), 8).collect()
    assert len(got) == 6 and len({(r["shard"], r["slot"]) for r in got}) == 6
    assert {r["size"] for r in got if r["doc_id"] in (2, 4)} == {1}
    assert sharding.shard_documents(clash(spark).limit(0), 8).count() == 0


# ------------------------------------------------------------ near duplicates

def brute_components(rows, n, percent):
    def shingled(t):
        w = (t or "").lower().split()
        k = min(n, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    sets = {i: shingled(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(rng):
    """Chains, stars and big groups of near copies, exact copies, short texts."""
    rows = []
    for g in range(12):
        base = prose(rng, rng.randint(20, 120)).split()
        for _ in range(rng.choice([1, 2, 5, 40])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 14))):
                t[rng.randrange(len(t))] = f"x{rng.randint(0, 9999)}"
            rows.append(" ".join(t))
            if g % 3 == 0:
                base = t                       # drifts: ends of the chain are no pair
    rows += ["One", "one", "two words", "Two  words", "", " \n ", "a b c d e"] * 2
    rng.shuffle(rows)
    return [(5 * i + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n", [2, 5])
def test_components_match_brute_force(spark, n):
    rows = near_rows(random.Random(n))
    want = brute_components(rows, n, 80)
    got = near_dup.near_duplicates(docs(spark, rows), words=n, percent=80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("chunk, heavy", [(1, 1000), (3, 4)])
def test_what_the_pivots_leave_is_compared_block_by_block(spark, monkeypatch, chunk, heavy):
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    monkeypatch.setattr(near_dup, "HEAVY", heavy)
    monkeypatch.setattr(near_dup, "_verified", lambda pairs, *_: pairs.limit(0))   # pivots find none
    rows = near_rows(random.Random(8))
    got = near_dup.near_duplicates(docs(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == \
        brute_components(rows, 2, 80)


def test_long_texts_make_smaller_chunks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK_SHINGLES", 150)
    monkeypatch.setattr(near_dup, "_verified", lambda pairs, *_: pairs.limit(0))
    rows = near_rows(random.Random(9))
    got = near_dup.near_duplicates(docs(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == \
        brute_components(rows, 2, 80)


def test_a_document_of_two_texts_links_by_each_text_alone(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words[:20])), (1, " ".join(words)), (2, " ".join(words[:21])),
            (3, " ".join([*words[:399], "z"])), (4, " ".join(words[:200]))]
    got = near_dup.near_duplicates(docs(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_common_counts_by_matrix_and_one_by_one(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(near_dup, "COLUMNS", 7)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(20)]
    p, q = (x.ravel() for x in np.meshgrid(np.arange(20), np.arange(20)))
    want = [len({*sets[i].tolist()} & {*sets[j].tolist()}) for i, j in zip(p, q, strict=True)]
    assert near_dup.common_counts(sets, sets, p, q).tolist() == want
    assert near_dup.common_counts(sets, sets, p[:50], q[:50]).tolist() == want[:50]


def test_near_duplicate_edge_rows(spark):
    got = near_dup.near_duplicates(clash(spark)).collect()
    assert len(got) == 6
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        (1, 2, 1, True), (None, 0, None, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True)}
    assert near_dup.near_duplicates(clash(spark).limit(0)).count() == 0
    two = docs(spark, [(1, "a b c"), (7, "a b c"), (7, "q r s"), (9, "q r s"), (None, "a b c")])
    assert {(r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(two).collect()} == {
        (1, 1), (7, 1), (9, 1), (None, None)}


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)],
                                  "a long, b long")
    got = {r["node"]: r["root"] for r in near_dup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


@pytest.mark.parametrize("heavy", [3, 1000])
def test_components_with_heavy_nodes(spark, monkeypatch, heavy):
    monkeypatch.setattr(near_dup, "HEAVY", heavy)
    pairs = [(500, i) for i in range(1, 120)] + [(i, 900) for i in range(60, 200)] + [
        (i, i + 1) for i in range(300, 310)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in near_dup.components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in [*range(2, 200), 500, 900]},
                   **{i: 300 for i in range(301, 311)}, **{1000 + i: 1000 for i in range(1, 50)}}


def test_posterior_bounds_keep_pairs_at_the_threshold():
    need = near_dup.least_matches(80)
    rng = np.random.default_rng(1)
    hits = rng.random((20_000, near_dup.HASHES)) < 0.8
    upto = hits.cumsum(axis=1)[:, near_dup.BATCH - 1::near_dup.BATCH]
    assert (upto >= need).all(axis=1).mean() > 0.9995
    low = (rng.random((2000, near_dup.HASHES)) < 0.4).cumsum(axis=1)[
        :, near_dup.BATCH - 1::near_dup.BATCH]
    assert (low >= need).all(axis=1).mean() < 0.01


def test_word_hash_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(words, "CACHE_WORDS", 5)
    table = words.WordHashes()
    for i in range(50):
        assert table[b"%d" % i] == table[b"%d" % i]
    assert len(table) <= 5


# ------------------------------------------------------------ language model

def brute_model(rows):
    texts = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    uni = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([0, *t[:-1]], t, strict=True))
    before = Counter(w for _, w in pairs)
    total = Counter()
    for (u, _), c in pairs.items():
        total[u] += c

    def ones(c):
        k = Counter(c.values())
        return [k[1], k[2], k[3], k[4]]
    d2, d1 = language_model.discounts(ones(pairs)), language_model.discounts(ones(before))

    def less(c, d):
        return c - d[min(c, 3) - 1] if c else 0
    v, n = len(uni), sum(uni.values())
    freed = sum(d1[min(c, 3) - 1] for c in before.values()) / max(len(pairs), 1)

    def p(u, w):
        low = less(before.get(w, 0), d1) / max(len(pairs), 1) + freed / (v + 1)
        if not total.get(u):
            return low
        kept = sum(d2[min(c, 3) - 1] for (x, _), c in pairs.items() if x == u)
        return less(pairs.get((u, w), 0), d2) / total[u] + kept / total[u] * low
    return texts, uni, n, v, p


def test_language_model_matches_brute_force_and_sums_to_one(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(0, 30), 40)) for i in range(60)] + [(99, "New words Ä")]
    texts, uni, n, v, p = brute_model(rows)
    got = {r["doc_id"]: r for r in language_model.language_model_scores(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in texts.items():
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r["n_tokens"], r["train_tokens"]) == (len(t), n)
        assert r["n_known"] == sum(w in uni for w in t)
        base = sum(math.log10((uni.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        own = sum(math.log10(p(u, w)) for u, w in zip([0, *t[:-1]], t, strict=True))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["score"], own, rel_tol=1e-9)
    for u in (0, b"w1", b"w7"):
        assert math.isclose(sum(p(u, w) for w in uni) + p(u, "unknown"), 1)


def test_hash_mix_has_an_inverse_and_blobs_round_trip():
    x = np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64)
    assert (language_model.gather(language_model.spread(x)) == x).all()
    assert (language_model.unpack(language_model.pack(x)) == x).all()
    s = np.sort(x)
    assert (language_model.unsteps(language_model.steps(s)) == s).all()


def test_language_model_edge_rows(spark):
    got = language_model.language_model_scores(clash(spark)).collect()
    assert len(got) == 6 and all(r["score"] <= 0 for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] is None] == [1]
    assert language_model.language_model_scores(clash(spark).limit(0)).count() == 0
    none = docs(spark, [(None, "a b"), (None, "c")])            # nothing to learn from
    assert all(r["n_known"] == 0 and r["score"] <= 0 and math.isfinite(r["base_score"])
               for r in language_model.language_model_scores(none).collect())
    with pytest.raises(ValueError, match="mounted"):
        language_model.local_path("hdfs://x/y")


# ------------------------------------------------------------ decontamination

def bench_rows(rng):
    items = [(i, prose(rng, rng.randint(12, 40), 150) + ("\n" if i % 2 else " ")
              + prose(rng, rng.randint(4, 12), 150)) for i in range(30)]
    return [*items, (30, items[0][1]), (31, ""), (32, None), (33, "two words"), (None, "n o p q r s t")]


def test_leaks_match_brute_force(spark):
    rng = random.Random(6)
    items = bench_rows(rng)
    rows = []
    for i in range(120):
        t = prose(rng, rng.choice([0, 3, 60, 400]), 150).split()
        if i % 4 == 0:
            words_ = (items[i % 30][1]).split()
            if i % 8 == 0:
                words_ = [w.upper() + "," if k % 5 == 0 else w for k, w in enumerate(words_)]
            at = rng.randint(0, len(t))
            t[at:at] = words_
        rows.append((i, " ".join(t)))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.leaks(docs(spark, rows), bench).collect()
    plain = {i: " ".join(decontaminate.words_of(t)) for i, t in items if t}
    want = {(d, i) for d, t in rows for i, p in plain.items()
            if f" {p} " in f" {' '.join(decontaminate.words_of(t))} "}
    assert want and {(r["doc_id"], r["item_id"]) for r in got} >= want
    # what else is found holds the parts, if not the whole
    assert all(r["question_overlap"] >= 0.5 and r["answer_overlap"] >= 0.5 for r in got)
    left = decontaminate.clean(docs(spark, rows), bench)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {r["doc_id"] for r in got}


def test_wand_returns_every_item_at_the_threshold():
    rng = random.Random(7)
    index = decontaminate.Index([(i, t) for i, t in bench_rows(rng) if i is not None and t])
    gains = {}
    for (t, _), (ids, g) in index.postings.items():
        for k, x in zip(ids, g, strict=True):
            gains[t, k] = x
    for _ in range(200):
        terms = np.array(sorted(rng.sample(range(len(index.terms)), rng.randint(1, 60))))
        least = rng.choice([0.1, 0.3, 0.6])
        want = {k for k in range(len(index.items))
                if sum(gains.get((t, k), 0.0) for t in terms) >= least}
        sums = index.most[terms].sum(axis=0)
        blocks = np.flatnonzero(sums >= least - 1e-5)
        assert {k for k, _ in index.wand(terms, least, blocks)} == want


def test_leaks_in_parts_and_edge_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (2, "g h i j k l")],
                                  "item_id long, text string")
    rows = docs(spark, [(1, "x a b c d e f"), (1, "x a b c d e f"), (2, None), (None, "g h i j k l"),
                        (3, "")])
    for chars in (decontaminate.PART_CHARS, 5):
        monkeypatch.setattr(decontaminate, "PART_CHARS", chars)
        got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.leaks(rows, bench).collect())
        assert got == [(0, 2), (1, 1), (1, 1)]
        assert {r["doc_id"] for r in decontaminate.clean(rows, bench).collect()} == {2, 3}
    assert decontaminate.leaks(rows, bench.limit(0)).count() == 0
    assert decontaminate.leaks(rows.limit(0), bench).count() == 0
    long = docs(spark, [(1, "a b c d e f " * 20_000), (2, "z" * 100_000)])
    assert [r["doc_id"] for r in decontaminate.leaks(long, bench).collect()] == [1]


# ------------------------------------------------------------ toxicity

def toxic_rows(rng, n):
    bad = ["vilex", "grubnak", "zornish"]
    rows = []
    for i in range(n):
        t = prose(rng, rng.randint(5, 150)).split()
        y = int(i % 4 == 0)
        for _ in range(3 * y):
            t.insert(rng.randint(0, len(t)), rng.choice(bad) + rng.choice(["", "er", "ous", ","]))
        rows.append((i, " ".join(t), y))
    return rows


def test_held_out_accuracy_and_whole_texts(spark):
    rng = random.Random(9)
    rows = toxic_rows(rng, 400)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    df = docs(spark, [(i, t) for i, t, _ in rows])
    params = toxicity.train(*toxicity.sample(df, labels))
    learned, _ = toxicity.sample(df, labels)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert not {t for i, t, _ in rows if i in held} & set(learned)
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, params=params).collect()}
    test = [(y, got[i]["predicted"]) for i, _, y in rows if got[i]["held_out"]]
    assert {i for i in got if got[i]["held_out"]} == held
    assert sum(a == b for a, b in test) / len(test) > 0.95
    scorer = toxicity.Scorer(params)
    clean = " ".join(prose(rng, 60) for _ in range(50))
    assert scorer.score([clean])[0] < 0.3
    assert scorer.score([clean + " vilex grubnak zornish " + clean])[0] > 0.3   # past any prefix


def test_gru_gradient_matches_differences():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (5, 3, 3 * toxicity.HIDDEN))
    u = rng.normal(0, 0.5, (toxicity.HIDDEN, 3 * toxicity.HIDDEN))
    mask = (np.arange(5)[:, None] < np.array([5, 3, 0])[None, :]).astype(float)
    d = rng.normal(0, 1, (5, 3, toxicity.HIDDEN))
    for back in (False, True):
        _, kept = toxicity.run_gru(x, u, mask, back)
        d_x, d_u = toxicity.gru_grad(d, kept, u, mask)
        for grad, of in ((d_x, x), (d_u, u)):
            for k in rng.integers(0, of.size, 12):
                step = np.zeros(of.size)
                step[k] = 1e-2
                step = step.reshape(of.shape)
                hi, lo = (np.sum(d * toxicity.run_gru(
                    x + s if of is x else x, u + s if of is u else u, mask, back)[0])
                    for s in (step, -step))
                assert abs((hi - lo) / 2e-2 - grad.ravel()[k]) < 1e-2


def test_windows_cover_and_long_texts_agree(monkeypatch):
    for n in (0, 1, 48, 49, 1000):
        spans = toxicity.windows(n)
        assert {k for a, b in spans for k in range(a, b)} == set(range(n))
    scorer = toxicity.Scorer(toxicity.init())
    t = prose(random.Random(1), 500)
    want = scorer.score([t, "x", None, ""])
    monkeypatch.setattr(toxicity, "TOKENS", 100)
    got = scorer.score([t, "x", None, ""])
    assert np.allclose(got[1:], want[1:]) and 0 <= got[0] <= 1
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 200)
    assert np.allclose(toxicity.Scorer(toxicity.init()).score(["x", None, ""]), want[1:])


def test_toxicity_edge_rows(spark):
    labels = spark.createDataFrame([(1, 0, 1), (None, 0, 1), (2, 0, None), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(clash(spark), labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert toxicity.toxicity(clash(spark).limit(0), labels.limit(0)).count() == 0


# ------------------------------------------------------------ quality rules

def plain_counts(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
            len({i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}))


def test_counts_match_plain_python(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("ab é#\n\t<\x1c\xa0") for _ in range(rng.randint(0, 80)))
             for _ in range(200)] + [None, "", "a b c a b c a b c", "x\n" * 500, "w " * 20_000]
    got = {r["doc_id"]: r for r in quality.text_counts(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == plain_counts(t), repr(t)[:80]


def test_thresholds_follow_their_group(spark):
    rng = random.Random(12)
    rows = []
    for s, symbols in (("plain", 0), ("marked", 20)):
        rows += [(len(rows) + i, " ".join([prose(rng, 100), "#" * symbols]), "en", s, 0)
                 for i in range(60)]
    rows += [(1000, prose(rng, 100) + "#" * 20, "en", "plain", 0),
             (1001, prose(rng, 100) + "#" * 20, "en", "marked", 0),
             (1002, prose(rng, 100) + "#" * 200, "en", "marked", 0),
             (1003, prose(rng, 100), None, None, 0), (1004, None, None, "x", 0),
             (None, prose(rng, 100), "en", "rare", 0)]
    got = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(rows)
    assert [got[k]["kept"] for k in (1000, 1001, 1002, 1003, 1004, None)] == [
        False, True, False, True, False, True]
    assert got[1004]["base_failed"] and got[1004]["n_words"] == 0


def test_quality_has_no_python_in_its_plan_and_takes_empty_tables(spark):
    df = spark.createDataFrame([], DOCS + ", rate string, bucket long, docs long")
    out = quality.quality(df)
    assert out.count() == 0
    plan = quality.text_counts(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert F.lit(1) is not None


def test_one_text_of_a_repeated_id_is_learned_from(spark):
    rows = [(1, "b b"), (1, "a a"), (1, None), (1, ""), (3, "c"), (None, "d"), (1, "a a"), (5, "x" * 9000)]
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 1), (None, 1)], "doc_id long, toxic int")
    want = [(i, t, y) for i, t, y in ((1, "a a", 1), (3, "c", 0)) if zlib.crc32(b"%d" % i) % 4 != 2]
    for parts in (1, 7):
        assert toxicity.sample(docs(spark, rows).repartition(parts), labels) == (
            [t for _, t, _ in want], [y for _, _, y in want])
