"""Lexical search, whitening and removal of repeated strings: against brute
force, and on nulls, empty and long texts, ties, repeats, empty tables and
columns with clashing names."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm import lexical_search, suffix_array, suffix_dedup, whitening

# ------------------------------------------------------------ lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain_search(rows, items, top=10):
    docs = [(i, Counter(plain_terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        q, scores = Counter(plain_terms(text)), []
        for i, c, size in docs:
            m = 25 + 75 * size * n // length
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s)
                for r, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()],
                  key=str)


@pytest.mark.parametrize("width", [16, 512, 1 << 16])
def test_search_matches_exhaustive_scores_at_any_width(spark, monkeypatch, width):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(60)] + ["Émile", "été", "x9", "日本"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", ".", "-a"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 30))) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(25)] + [(i, "w1 " * 400) for i in (900, 901)]
    items = [(i, text(rng.randint(1, 12))) for i in range(9)] + [(90, "nowhere"), (91, "w1 W1 w2")]
    monkeypatch.setattr(lexical_search, "ITEMS", 4)        # three blocks
    monkeypatch.setattr(lexical_search, "LEXICON", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lexical_search.search(docs, spark.createDataFrame(items, "item_id long, text string"),
                                seeds=12, width=width)
    assert found(got) == plain_search(rows, items)


def test_shuffled_candidates_give_the_same_ranking(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BROADCAST_ROWS", 0)
    rows = [(i, f"a{i % 7} b{i % 5} c") for i in range(80)]
    items = [(1, "a1 b1 c"), (2, "c")]
    got = lexical_search.search(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == plain_search(rows, items)


def test_search_on_odd_rows(spark):
    schema = ("doc_id long, text string, item long, k1 long, k2 long, bound double, t string, "
              "id long, n long, score double, rank int")
    rows = [(1, "a b", *[0] * 4, 0.0, "x", 0, 0, 0.0, 0)] * 2
    rows = [(i, t, 7, 7, 7, 1.0, "x", 7, 7, 1.0, 7) for i, t in (
        (1, "a b"), (1, "a b"), (None, "a b"), (None, None), (2, ""), (3, " .\n"), (4, None),
        (5, "a " * 50_000), (6, "A"))]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame(
        [(1, "a b", 1), (1, "a b", 1), (2, None, 1), (3, "", 1), (None, "b", 1), (4, "zz", 1)],
        "item_id long, text string, item int")
    got = lexical_search.search(docs, items)
    assert found(got) == plain_search([(r[0], r[1]) for r in rows], [(1, "a b"), (None, "b")])
    none = docs.limit(0)
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).columns == [
        "item_id", "rank", "doc_id", "score"]


def test_sketches_hold_coordinatewise_maxima():
    rng = random.Random(5)
    counts = [Counter(f"t{rng.randrange(90)}".encode() for _ in range(rng.randrange(300)))
              for _ in range(20)] + [Counter(), Counter({b"x": 5000})]
    coords, codes, ends = lexical_search.fold(counts, 32)
    table = lexical_search.WordHashes()
    for c, a, b in zip(counts, [0, *ends[:-1]], ends, strict=True):
        want = defaultdict(int)
        for t, n in c.items():
            want[table[t] % 32] = max(want[table[t] % 32], n)
        levels = lexical_search.LEVELS[codes[a:b]]
        assert coords[a:b].tolist() == sorted(want)
        assert all(v >= want[k] and (v == want[k] or want[k] > 200)
                   for k, v in zip(coords[a:b].tolist(), levels, strict=True))


# ------------------------------------------------------------ whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_whitening(vectors, wanted=32):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    scaled = n * x.astype(object) - s.astype(object)
    c = scaled.astype(np.float64) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:wanted], q[:, ::-1][:, :wanted]
    return e / np.trace(v), (c @ q) / np.sqrt(e), (scaled**2).sum(axis=1).tolist()


def check_whitening(got, ids, vectors, wanted=32):
    share, white, deviation = plain_whitening(vectors, wanted)
    table = got.toPandas()
    assert len(table) == len(ids) * len(share)
    back = table.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    back *= np.sign((back * white).sum(axis=0))
    assert np.abs(back - white).max() < 1e-7
    assert np.allclose(table.drop_duplicates("component").sort_values("component").explained, share,
                       rtol=1e-9)
    assert table.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].tolist() == deviation
    assert table.identity_error.nunique() == 1 and table.identity_error[0] < 1e-8
    assert set(table.n) == {len(ids)}


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_whitening_matches_a_full_decomposition(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 48)) * np.linspace(0.2, 1, 48) * scale
    x[::3] = x[0]                                      # a third of all rows are one vector
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    check_whitening(whitening.whiten(df.repartition(5)), list(range(700)), x)
    check_whitening(whitening.whiten(df, wanted=5), list(range(700)), x, 5)


def test_filter_finds_the_leading_space_without_its_matrix():
    rng = np.random.default_rng(4)
    for values in (np.linspace(50, 60, 90), np.r_[np.full(4, 9.0), np.full(86, 1.0)],
                   np.r_[1e6, 1e3, np.linspace(1, 2, 88)], np.r_[np.linspace(5, 6, 10), np.zeros(80)]):
        q = np.linalg.qr(rng.normal(size=(90, 90)))[0]
        v = q @ np.diag(values) @ q.T
        e, u, report = whitening.components(lambda y, v=v: v @ y, 90, 12)
        want = np.sort(values)[::-1][:12]
        want = want[want > 1e-9]
        assert np.allclose(e, want, rtol=1e-10) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-10)
        assert np.abs(v @ u - u * e).max() < 1e-9 * values.max()
        assert report["residual"] <= whitening.STALLED


def test_chebyshev_filter_damps_its_interval():
    v = np.diag(np.r_[10.0, np.linspace(1, 3, 30)])
    mid, half = whitening.interval(1.0, 3.0, 10.0)
    y = whitening.filtered(lambda x: v @ x, np.ones((31, 1)), v @ np.ones((31, 1)), mid, half, 10.0, 10)
    assert abs(y[0, 0]) > 0.5 and np.abs(y[1:]).max() < 1e-7


def test_whitening_edge_rows(spark):
    schema = VECTORS + ", id long, x double, dim int, component int, n long"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 0.5]), (4, None), (5, [None, 1.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0]), (10, [0.25, -0.125]),
            (11, [3e38, 1.0])]
    df = spark.createDataFrame([(i, v, 0, 1, 1.0, 1, 1, 1) for i, v in rows], schema)
    got = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in got) == {1: 4, None: 2, 10: 2}
    assert {r["n"] for r in got} == {4}
    for same in (df.limit(0), df.filter("vec_id = 1"), df.filter("vec_id = 4")):
        assert whitening.whiten(same).count() == 0       # no variance, no component
    # a dimension that never changes gives no component of its own
    flat = spark.createDataFrame([(i, [float(i), 7.0], 0) for i in range(9)], VECTORS)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}


def test_large_entries_take_exact_integers(spark):
    x = np.array([[2.0**40, 1.0], [-(2.0**41), 3.0], [5.0, 2.0**42]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>")
    got = whitening.whiten(df).select("vec_id", "deviation").distinct().collect()
    assert all(r["deviation"] is None for r in got) and len(got) == 3
    centre = whitening.Centre(3, [2**62, 0], 2**62)
    assert not centre.small
    assert centre.scaled(np.array([[2**61, 1]])).tolist() == [[3 * 2**61 - 2**62, 3]]


# ------------------------------------------------------------ suffix arrays

def symbols(rng, n, kinds):
    return np.append(rng.integers(1, kinds + 1, n), 0)


def test_suffix_arrays_and_prefixes_match_sorting(monkeypatch):
    rng = np.random.default_rng(6)
    for t in range(300):
        monkeypatch.setattr(suffix_array, "SMALL", int(rng.integers(1, 6)))
        monkeypatch.setattr(suffix_array, "SHORT", t % 2 * 100)      # recursion to the end, too
        s = symbols(rng, int(rng.integers(0, 80)), int(rng.integers(1, 5)))
        if t % 3 == 0:
            s = np.append(np.repeat(s[:-1], rng.integers(1, 9, len(s) - 1)), 0)
        plain = s.tolist()
        sa = suffix_array.suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: plain[i:])
        prefix = suffix_array.permuted_prefixes(s, sa)
        assert prefix[sa[0]] == 0
        for a, b in zip(sa[1:], sa[:-1], strict=True):
            n = 0
            while plain[a + n] == plain[b + n]:
                n += 1
            assert prefix[a] == n


def test_common_prefixes_of_long_runs_and_limits():
    s = np.array([1] * 5000 + [2] * 7 + [1] * 4000 + [0])
    assert suffix_array.common(s, np.array([0, 5]), np.array([5007, 5009])).tolist() == [4000, 3998]
    assert suffix_array.common(s, np.array([0]), np.array([5007]), np.array([33])).tolist() == [33]


# ------------------------------------------------------------ repeated strings

def plain_removal(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(r)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeated_texts(seed):
    rng = random.Random(seed)
    letters = "abcdefgh é\n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    base = text(700)
    out = [None, "", "abc", "a" * 300, "ab" * 90 + "x", "a" * 19, "q" * 20, "r" * 21]
    for _ in range(110):
        a, pre = rng.randrange(600), text(rng.randrange(60))
        out.append(pre + base[a:a + rng.randrange(10, 100)] + pre[::-1]
                   + base[a // 2:a // 2 + rng.randrange(40)])
    near = list(base)
    for _ in range(25):                                  # a family of near copies
        near[rng.randrange(len(near))] = rng.choice(letters)
        out.append("".join(near))
    return out + out[20:30] + [base] * 3


@pytest.mark.parametrize("seed,hot,batch", [(1, 8192, 1 << 20), (2, 8192, 1000), (3, 1, 1000)])
def test_removal_matches_brute_force(spark, monkeypatch, seed, hot, batch):
    """Also with every anchor taken for a hot one, and with many suffix arrays."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    texts = repeated_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeats(
        df, length=20, hot_kinds=hot, keep_text=True).collect()}
    for i, want in enumerate(plain_removal(texts, 20)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"],
                bytes(r["kept"])) == want, texts[i]


def test_removal_at_full_length(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(n))
    passage, long = text(120)[:400], text(9000)
    texts = [text(30) + "|" + passage + "|" + text(40), passage, passage[:399], text(200),
             long, long[:700] + "!" + long[701:5000], "z" * 2000, "y" * 400, "x" * 401]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.without_repeats(df).collect()}
    for i, want in enumerate(plain_removal(texts, 400)):
        assert got[i] == want[:4], i
    assert got[1][1] == 400 and got[2][1] == 0 and got[7][1] == 0 and got[8][1] == 401


def test_anchors_are_shared_by_equal_strings():
    rng = np.random.default_rng(9)
    hashes = suffix_dedup.Hashes()
    for kinds in (1, 2, 3, 60):
        raw = rng.integers(0, kinds, 400).astype(np.uint8)
        hashes.of(raw)
        pos, found_ = suffix_dedup.anchors(hashes, 24, 8)
        at = np.arange(len(raw) - 7)
        h = hashes.ranges(at, at + 8)
        for start in range(len(raw) - 23):
            inside = (pos >= start) & (pos <= start + 16)
            assert h[start:start + 17].min() in found_[inside]


def test_removal_on_odd_rows(spark):
    schema = ("doc_id long, text string, k1 long, k2 int, pos int, h long, raw binary, maybe int, "
              "spans int, id long")
    same = "one text that is there more than once, row by row"
    rows = [(i, t, 1, 1, 1, 1, b"", 1, 1, 1) for i, t in (
        (1, same), (1, same), (None, same), (None, None), (2, ""), (3, "short"), (1, "another"))]
    df = spark.createDataFrame(rows, schema)
    got = suffix_dedup.without_repeats(df, length=20)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((r[0] or 0, r[1], r[2]) for r in got.collect()) == [
        (0, 0, 0), (0, 49, 49), (1, 7, 0), (1, 49, 49), (1, 49, 49), (2, 0, 0), (3, 5, 0)]
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(df, length=2)
    assert got.filter(F.col("doc_id") == 3).first()["kept_sha256"] == hashlib.sha256(b"short").hexdigest()


def test_key_filters_pass_all_their_keys_and_few_others(spark):
    from tickflow.llm.common import key_filter
    far = 2**62 + 1
    keys = spark.range(0, 2000, 2).withColumnRenamed("id", "key").unionByName(
        spark.sql(f"select explode(array(cast(null as long), {far})) as key"))
    maybe = key_filter(keys, "key")
    ends = spark.sql(f"select explode(array(null, {far})) as id").coalesce(1)
    assert {r["id"] for r in ends.filter(maybe("id")).collect()} == {far}
    rows = spark.range(4000).select(maybe("id").alias("m"), "id").unionByName(
        spark.sql("select cast(null as long) as id").select(maybe("id").alias("m"), "id")).collect()
    assert all(r["m"] for r in rows if r["id"] is not None and r["id"] < 2000 and r["id"] % 2 == 0)
    assert sum(r["m"] for r in rows) < 1010 and not any(r["m"] for r in rows if r["id"] is None)


def test_key_filters_send_the_driver_one_filter_from_many_tasks(spark, monkeypatch):
    from tickflow.llm import common
    was = spark.conf.get("spark.sql.shuffle.partitions")
    keys, sent = spark.range(0, 64000, 2, 32), []
    collect = type(keys).collect

    def counted(df):
        rows = collect(df)
        sent.append(sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))))
        return rows

    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")    # 8 tasks build the filter
        with monkeypatch.context() as m:
            m.setattr(type(keys), "collect", counted)
            maybe = common.key_filter(keys, "id")
            none = common.key_filter(keys.limit(0), "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert len(sent) == 2 and 0 < sent[0] <= common.FILTER_BITS // 8 and sent[1] == 0
    passed = [r[0] for r in spark.range(64000).filter(maybe("id")).collect()]
    assert {n for n in passed if n % 2 == 0} == set(range(0, 64000, 2)) and len(passed) < 32100
    assert spark.range(64000).filter(none("id")).isEmpty()
