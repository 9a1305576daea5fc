"""Near duplicates by MinHash with sequential Bayesian verification.

Documents with equal shingle sets are one node. Nodes that share a band of
their signatures meet in a bucket. First each member is compared with its
bucket's most central node, so copies of one text link to it. What may be left
are links between different components of a bucket: buckets of one pivot make
a cluster, cut into chunks of about ``CHUNK`` nodes, and each pair of chunks is
compared in one task, so a cluster's pairs never become rows. A pair is
compared signature batch by signature batch and dropped once its similarity is
unlikely to reach the threshold given the matches so far; survivors are
verified on their full shingle sets. Blocks are compared by signatures first:
a text travels only to blocks in which a pair of it survived.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import key_filter, map_rows, slices, written
from tickflow.llm.words import mixed, shingles

HASHES = 240
BAND = 6                 # hashes a band: a pair at 0.8 misses all 40 bands with 5 in a million
BATCH = 24               # signature hashes compared at a time
MISS = 1e-6              # a pair whose posterior chance of reaching the threshold is less goes
CHUNK = 256              # nodes of a cluster in a chunk, on average
CHUNK_SHINGLES = 1 << 18  # and their shingles, on average: long texts make smaller chunks
HEAVY = 1000             # a key of more rows may be heavy, see components()
COLUMNS = 2048           # shingles hashed at a time
SETS = 64                # shingle sets remembered by a verifying task


def hash_family(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 2**63, n, dtype=np.uint64)[:, None]


def signature(sh: np.ndarray, family) -> bytes:
    """One 16-bit fingerprint of the least hashed shingle per hash function."""
    a, b = family
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(sh), COLUMNS):
        x = a * sh[None, at:at + COLUMNS]
        x += b
        np.minimum(low, x.min(axis=1), out=low)
    return (mixed(low) >> np.uint64(48)).astype(np.uint16).tobytes()


def least_matches(percent: int, hashes: int = HASHES, batch: int = BATCH,
                  miss: float = MISS) -> list[int]:
    """For each batch end n, the least matches m among n hashes that keep a
    pair: under a uniform prior the similarity's posterior is Beta(m + 1,
    n - m + 1), which exceeds t with the chance that a binomial of n + 1
    trials of t is at most m."""
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append(m)
    return out


def sketches(df: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """id, n_shingles, set digest (null for an empty set), signature."""
    def make():
        family = hash_family()

        def fn(ids, texts):
            sizes, sets, sigs = [], [], []
            for t in texts:
                sh = shingles(t, n)
                sizes.append(len(sh))
                sets.append(hashlib.md5(sh.tobytes()).digest() if len(sh) else None)
                sigs.append(signature(sh, family) if len(sh) else None)
            return [ids, sizes, sets, sigs]
        return fn

    return map_rows(df, [F.col(id_col).cast("long"), F.col(text).cast("string")],
                    "id long, n long, digest binary, sig binary", make)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that survive the sequential comparison of signatures."""
    need = least_matches(percent)
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sig_a", "sig_b")

    def run(batches):
        for batch in slices(batches, 4096):
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                           .reshape(-1, HASHES) for c in (2, 3))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for k, least in enumerate(need):
                part = slice(k * BATCH, (k + 1) * BATCH)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield batch.select([0, 1]).take(pa.array(alive))

    return rows.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold. Texts meet their pairs
    by the same plan at every size; the fewer texts of the pairs' ``a`` go last."""
    side = lambda x: texts.join(pairs.select(F.col(x).alias("node")).distinct().hint("merge"),
                                "node", "left_semi").select(
        F.col("node").alias(x), F.col("text").alias(f"text_{x}")).hint("merge")
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        known: OrderedDict = OrderedDict()

        def of(node, text):
            if node not in known:
                known[node] = shingles(text, n)
                if len(known) > SETS:
                    known.popitem(last=False)
            known.move_to_end(node)
            return known[node]

        for batch in slices(batches):
            keep = []
            for a, b, ta, tb in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                x, y = of(a, ta), shingles(tb, n)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def common_counts(left: list, right: list, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left[p] and right[q] (sorted sets)."""
    if len(p) < 200:
        return np.array([len(np.intersect1d(left[i], right[j], assume_unique=True))
                         for i, j in zip(p, q, strict=True)], np.int64)
    rows = [*left, *right]
    values = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, col, seen = np.unique(values, return_inverse=True, return_counts=True)
    shared = seen > 1
    keep = shared[col]
    col, owner = (np.cumsum(shared) - 1)[col[keep]], owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(shared.sum()), COLUMNS):      # some shared shingles at a time
        lo, hi = np.searchsorted(col, (at, at + COLUMNS))
        dense = np.zeros((len(rows), COLUMNS), np.float32)
        dense[owner[lo:hi], col[lo:hi] - at] = 1
        both += dense[:len(left)] @ dense[len(left):].T
    return both[p, q].astype(np.int64)


def _block_pairs(table: pa.Table, percent: int, need: list[int]) -> np.ndarray:
    """Row numbers (x, y) of a block's pairs of different components whose sizes
    allow the threshold and whose signatures survive."""
    size, comp, part = (np.array(table.column(c).to_pylist(), np.int64)
                        for c in ("n", "comp", "chunk"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
    small = 100 * np.minimum(size[a][:, None], size[b][None, :])
    ask = (comp[a][:, None] != comp[b][None, :]) & (
        small >= percent * np.maximum(size[a][:, None], size[b][None, :]))
    if i == j:
        ask &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    p, q = np.nonzero(ask)
    found = [np.empty((0, 2), np.int64)]
    for at in range(0, len(p), 1 << 16):
        x, y = a[p[at:at + (1 << 16)]], b[q[at:at + (1 << 16)]]
        matches = np.zeros(len(x), np.int64)
        for k, least in enumerate(need):
            cut = slice(k * BATCH, (k + 1) * BATCH)
            matches += (sig[x, cut] == sig[y, cut]).sum(axis=1)
            alive = matches >= least
            x, y, matches = x[alive], y[alive], matches[alive]
        found.append(np.stack([x, y], axis=1))
    return np.concatenate(found)


def _alive_in_blocks(blocks: DataFrame, percent: int) -> DataFrame:
    """The rows of each block of two chunks of a cluster (i = j: within one
    chunk) that belong to a surviving pair."""
    need = least_matches(percent)

    def run(table: pa.Table) -> pa.Table:
        return table.take(pa.array(np.unique(_block_pairs(table, percent, need))))

    return blocks.groupBy("pivot", "i", "j").applyInArrow(run, blocks.schema)


def _between_chunks(rows: DataFrame, percent: int, n: int) -> DataFrame:
    """Links between nodes of different components, by block: the pairs of its
    surviving rows, verified on their texts' shingle sets."""
    need = least_matches(percent)

    def run(table: pa.Table) -> pa.Table:
        pairs = _block_pairs(table, percent, need)
        if len(pairs):
            texts, node = table.column("text"), np.array(table.column("node").to_pylist(), np.int64)
            left, p = np.unique(pairs[:, 0], return_inverse=True)
            right, q = np.unique(pairs[:, 1], return_inverse=True)
            sets = {k: shingles(texts[k].as_py(), n) for k in {*left.tolist(), *right.tolist()}}
            xs, ys = [sets[k] for k in left.tolist()], [sets[k] for k in right.tolist()]
            both = common_counts(xs, ys, p, q)
            total = np.array([len(x) for x in xs])[p] + np.array([len(y) for y in ys])[q] - both
            pairs = np.sort(node[pairs[100 * both >= percent * total]], axis=1)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return rows.groupBy("pivot", "i", "j").applyInArrow(run, "a long, b long")


def _beside(rows: DataFrame, least: DataFrame, key: str, heavy: int) -> DataFrame:
    """``rows`` with the columns of ``least``, one row per ``key`` that counts its
    rows in c. A key of more than ``heavy`` rows is joined by broadcast, where its
    rows lie."""
    few = F.broadcast(least.filter(F.col("c") > heavy).drop("c"))
    return rows.join(few, key).unionByName(
        rows.join(few.select(key), key, "left_anti").join(
            least.filter(F.col("c") <= heavy).drop("c"), key))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b) but the roots, root the
    least node of its component: large-star and small-star steps until the
    edges form stars, that is until no node has two parents or is both a
    parent and a child.

    The neighbours of a node never meet in one task: least neighbours are
    combined before the shuffle, and a node with more than 1/1000 of all edge
    ends (1000 such nodes at most) gets its least neighbour by broadcast."""
    now = written(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                  .filter("v <> u").distinct(), "cc")
    while True:
        roles = now.select(F.col("v").alias("node"), F.lit(1).alias("child"), "u").unionByName(
            now.select(F.col("u").alias("node"), F.lit(0).alias("child"),
                       F.lit(None).cast("long").alias("u")))
        tangled = roles.groupBy("node").agg(
            F.min("child").alias("lo"), F.max("child").alias("hi"), F.min("u").alias("first"),
            F.max("u").alias("last")).filter("lo <> hi or first <> last")
        if tangled.isEmpty():
            return now.select(F.col("v").alias("node"), F.col("u").alias("root"))
        heavy = max(2 * now.count() // 1000, HEAVY)
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = written(both.groupBy("v").agg(
            F.least(F.min("u"), F.col("v")).alias("m"), F.count(F.lit(1)).alias("c")), "cc-least")
        large = written(_beside(both.filter("u > v"), least, "v", heavy).select(
            F.col("u").alias("v"), F.col("m").alias("u")), "cc-large")
        low = written(large.groupBy("v").agg(
            F.min("u").alias("m"), F.count(F.lit(1)).alias("c")), "cc-least")
        small = _beside(large, low, "v", heavy).select(
            F.col("u").alias("v"), F.col("m").alias("u")).unionByName(
                low.select("v", F.col("m").alias("u")))
        now = written(small.filter("v <> u").distinct(), "cc")


def near_duplicates(df: DataFrame, *, words: int = 2, percent: int = 80,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id reachable
    over links of shingle sets with 100 * intersection >= percent * union),
    kept (id = component_id).

    Null, empty and wordless texts have an empty set, link with nothing and
    are kept. Rows of one id are one document, whatever their texts; equal
    texts are linked. A row without an id links with nothing: its component_id
    is null and it is kept. An empty table gives none; other columns are
    ignored. Ids are integers."""
    docs = written(sketches(df, id_col, text, words), "neardup-sketches")
    with_id = docs.filter(F.col("id").isNotNull() & F.col("digest").isNotNull())
    nodes = written(with_id.groupBy("digest").agg(
        F.min("id").alias("node"), F.max("n").alias("n"), F.max("sig").alias("sig")),
        "neardup-nodes")
    twice = with_id.select("id", "digest").distinct().groupBy("id").agg(
        F.count(F.lit(1)).alias("c")).filter("c > 1")     # ids with several texts
    links = written(with_id.select("id", "digest").join(twice, "id", "left_semi").join(
        nodes.select("digest", "node"), "digest").select(
            F.col("node").alias("a"), F.col("id").alias("b")), "neardup-links")
    labels = None if links.isEmpty() else components(links)
    bands = nodes.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda k: F.xxhash64(F.substring(F.col("sig"), k * (2 * BAND) + 1, F.lit(2 * BAND)), k)
    )).alias("bucket")).repartition("bucket")
    # Both sides read all columns of one and the same exchange.
    shared = bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("c"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter(
            "lo <> hi").select("bucket", "c")
    members = written(bands.join(shared, "bucket"), "neardup-members")
    # The copy that the others were made from shares the most buckets with them:
    # as the pivot it links those that are no pairs among themselves.
    central = members.groupBy("node").agg(F.sum("c").alias("ties"))
    # Signatures and texts that may be needed; the filter spares the others all
    # shuffles, and the joins below keep those that are needed.
    maybe = key_filter(members.select("node").distinct(), "node")
    nodes_left = written(nodes.filter(maybe("node")).select("node", "n", "sig"), "neardup-signatures")
    texts = written(df.select(F.col(id_col).cast("long").alias("node"),
                              F.col(text).cast("string").alias("text")).filter(maybe("node")),
                    "neardup-texts")
    members = members.drop("c").join(central, "node").join(nodes_left.select("node", "n"), "node")

    def buckets(members: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with the pivot."""
        now = members.withColumn("comp", F.col("node")) if labels is None else members.join(
            labels, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        now = written(now, "neardup-members")
        mixed_buckets = now.groupBy("bucket").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct(
                -F.col("ties"), F.col("node").alias("pivot"), F.col("comp").alias("comp2"),
                F.col("n").alias("n2"))).alias("p")).filter("lo <> hi")
        return now.join(mixed_buckets.select("bucket", "p.pivot", "p.comp2", "p.n2"), "bucket")

    # Every member against its pivot.
    members = written(buckets(members), "neardup-members")
    pairs = written(members.filter("comp <> comp2").filter(
        100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")).select(
            F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(),
        "neardup-pairs")
    likely = written(_likely(pairs, nodes_left, percent), "neardup-likely")
    links = written(links.unionByName(_verified(likely, texts, percent, words)), "neardup-links")
    labels = None if links.isEmpty() else components(links)
    # What is left: clusters of several components, block by block.
    cluster = written(buckets(members.select("bucket", "node", "n", "ties")).select(
        "pivot", "node", "n", "comp").distinct(), "neardup-clusters")
    rows = cluster.count()
    if rows:
        size = written(cluster.groupBy("pivot").agg(F.greatest(
            F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("k"),
            F.count(F.lit(1)).alias("c")), "neardup-sizes")
        blocks = _beside(cluster, size, "pivot", max(rows // 1000, HEAVY)).withColumn(
            "chunk", F.pmod(F.xxhash64("node"), F.col("k"))).withColumn(
                "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))).select(
                    "pivot", F.least("chunk", "other").alias("i"),
                    F.greatest("chunk", "other").alias("j"), "chunk", "node", "n", "comp")
        blocks = written(_alive_in_blocks(
            blocks.join(nodes_left.select("node", "sig"), "node"), percent), "neardup-blocks")
        links = written(links.unionByName(_between_chunks(
            blocks.join(texts, "node"), percent, words)), "neardup-links")
        labels = None if links.isEmpty() else components(links)
    rows = docs.join(nodes.select("digest", "node"), "digest", "left")
    if labels is not None:
        rows = rows.join(labels, "node", "left")
    else:
        rows = rows.withColumn("root", F.lit(None).cast("long"))
    comp = F.when(F.col("id").isNull(), F.lit(None)).otherwise(
        F.coalesce("root", "node", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       comp.alias("component_id"),
                       F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))
