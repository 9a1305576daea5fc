"""Ranked lexical search by hashed max-sketches.

Index: every text is folded into a sketch of ``WIDTH`` coordinates. A term
falls on the coordinate that its hash names; where terms share one, the largest
count stays. A text's impact grows with the count, so the largest count is the
largest impact, whatever the lengths turn out to be. Sketches are kept sparse
(coordinate, count code), next to a lexicon of document frequencies.

Search: items come in blocks. Workers look the block's coordinates up in whole
batches of sketches; one matrix product bounds the score of each text for each
item from above. The texts of the highest bounds are scored exactly; the worst
of an item's best scores is its threshold, and all texts whose bounds reach it
are scored exactly, too. Equal texts are scored once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import process_cache, shared_dir, slices, written
from tickflow.llm.words import WordHashes

WIDTH = 1 << 16           # coordinates of a sketch; two bytes name one
SEEDS = 32                # texts an item scored first, by falling bound
TOP = 10
ITEMS = 256               # items of a block at most
CELLS = 1 << 22           # coordinates times items of a block at most, but for a single item
CHUNK = 1024              # sketches bounded at a time
LEXICON = 200_000         # terms that a task counts before it lets go of them
BROADCAST_ROWS = 100_000  # candidate texts sent to all tasks at most; more are shuffled
SLACK = 1 + 1e-3          # above the rounding of single-precision sums of CELLS numbers
# Separators become spaces, A-Z become a-z; bytes from 0x80 on belong to terms.
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
# Counts a code stands for: exact up to 200, then the next larger of rising steps.
LEVELS = np.array([*range(201), *(int(200 * 1.25 ** k) for k in range(1, 55)), 2**62], np.int64)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode(errors="replace").translate(TABLE).split()


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One cell of ``values`` (of any width) per row; ``ends`` count values."""
    offsets = np.append(0, ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def fold(counts: list[Counter], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coordinates, count codes, ends per text): coordinatewise maxima."""
    table = process_cache("word hashes", WordHashes)
    size = [len(c) for c in counts]
    flat = np.fromiter((table[t] for c in counts for t in c), np.uint64, sum(size))
    tf = np.fromiter((n for c in counts for n in c.values()), np.int64, sum(size))
    key = (np.repeat(np.arange(len(counts), dtype=np.uint64), size) << np.uint64(32)) | (
        flat % np.uint64(width))
    order = np.argsort(key, kind="stable")
    key, tf = key[order], tf[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else \
        np.empty(0, np.int64)
    key, tf = key[first], np.maximum.reduceat(tf, first) if len(key) else tf
    ends = np.searchsorted(key, np.arange(1, len(counts) + 1, dtype=np.uint64) << np.uint64(32))
    return (key.astype(np.uint16), np.searchsorted(LEVELS, tf).astype(np.uint8), ends)


@dataclass
class Index:
    sketches: DataFrame       # id, k1, k2, n, coords, codes
    lexicon: DataFrame        # term, df: partial counts
    documents: int
    length: int               # all terms of all documents
    width: int


def text_key(text: str) -> list:
    """128 bits of a text: equal texts are scored once."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def build_index(df: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                width: int = WIDTH) -> Index:
    """Sketches of all rows with a term, and their lexicon. One pass over the
    texts; no shuffle."""
    if not 0 < width <= WIDTH:
        raise ValueError(f"width must be 1 to {WIDTH}")
    kind = df.schema[id_col].dataType.simpleString()
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "sketches")
    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("t")).select(
        "id", *text_key("t"), "t")

    def lexicon_batch(seen: Counter, ids: pa.DataType) -> pa.RecordBatch:
        n = len(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(["terms"] * n), pa.nulls(n, ids), pa.nulls(n, pa.int64()),
             pa.nulls(n, pa.int64()), pa.array(list(seen.values()), pa.int64()),
             pa.array(list(seen), pa.binary()), pa.nulls(n, pa.binary())],
            names=["part", "id", "k1", "k2", "n", "coords", "codes"])

    def run(batches):
        seen, ids = Counter(), None
        for batch in slices(batches):
            ids = batch.column(0).type
            found = [terms(t) for t in batch.column(3).to_pylist()]
            keep = [i for i, f in enumerate(found) if f]
            counts = [Counter(found[i]) for i in keep]
            coords, codes, ends = fold(counts, width)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(["sketches"] * len(keep)), *kept.columns[:3],
                 pa.array([len(found[i]) for i in keep], pa.int64()), _binary(coords, ends),
                 _binary(codes, ends)],
                names=["part", "id", "k1", "k2", "n", "coords", "codes"])
            for c in counts:
                seen.update(c.keys())
            if len(seen) > LEXICON:
                yield lexicon_batch(seen, ids)
                seen.clear()
        if seen:
            yield lexicon_batch(seen, ids)

    schema = f"part string, id {kind}, k1 long, k2 long, n long, coords binary, codes binary"
    rows.mapInArrow(run, schema).write.partitionBy("part").parquet(path)
    back = spark.read.schema(schema).option("basePath", path)
    all_rows = back.parquet(path)
    sketches = all_rows.filter("part = 'sketches'").select("id", "k1", "k2", "n", "coords", "codes")
    lexicon = all_rows.filter("part = 'terms'").select(F.col("coords").alias("term"),
                                                       F.col("n").alias("df"))
    total = sketches.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    return Index(sketches, lexicon, total["n"], total["l"] or 0, width)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def exact(counts: Counter, n: int, item: list[tuple[bytes, int]], index_n: int, index_l: int
          ) -> int:
    """Score of a text for an item of (term, repeats times weight)."""
    m = 100 - 75 + (75 * n * index_n) // index_l
    return sum(w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
               for t, w in item if t in counts)


@dataclass
class Block:
    ids: list                               # item ids
    items: list[list[tuple[bytes, int]]]    # (term, repeats times weight), terms of the corpus
    coords: np.ndarray                      # coordinates in use
    weights: np.ndarray                     # coordinate x item
    documents: int
    length: int

    def bounds(self, n: np.ndarray, coords: np.ndarray, codes: np.ndarray, ends: np.ndarray
               ) -> np.ndarray:
        """Upper bounds, text x item, of sketches given as flat arrays."""
        size = np.diff(ends, prepend=0)
        row = np.repeat(np.arange(len(n)), size)
        place = np.full(WIDTH, -1, np.int32)
        place[self.coords] = np.arange(len(self.coords))
        at = place[coords]
        hit = at >= 0
        row, at, tf = row[hit], at[hit], LEVELS[codes[hit]].astype(np.float64)
        # Below the text's m, so that the impact is not below its own.
        m = 24 + 75.0 * n * self.documents / self.length * (1 - 1e-12)
        impact = np.zeros((len(n), len(self.coords)), np.float32)
        impact[row, at] = 1e9 * tf / (1000 * tf + 8 * m[row])
        return (impact @ self.weights) * SLACK


def _sketch_chunks(batches):
    """(key columns, n, coords, codes, ends) of texts not met before in the task."""
    seen = set()
    for batch in slices(batches, CHUNK):
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        fresh = []
        for i, k in enumerate(keys):
            if k not in seen:
                seen.add(k)
                fresh.append(i)
        if not fresh:
            continue
        batch = batch.take(pa.array(fresh))
        coords, codes = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t)
                         for c, t in ((3, np.uint16), (4, np.uint8)))
        ends = np.cumsum(pa.compute.binary_length(batch.column(4)).to_numpy())
        yield (batch.column(0).to_numpy(), batch.column(1).to_numpy(),
               batch.column(2).to_numpy().astype(np.float64), coords, codes, ends)


FOUND = "item int, k1 long, k2 long, bound double"


def _found(item, k1, k2, bound) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
         pa.array(bound, pa.float64())], names=["item", "k1", "k2", "bound"])


def _highest(index: Index, block: Block, seeds: int) -> DataFrame:
    """The ``seeds`` texts of the highest positive bounds, per item."""
    def run(batches):
        best = k1 = k2 = None
        for a, b, *sketch in _sketch_chunks(batches):
            got = block.bounds(*sketch)
            a, b = np.broadcast_to(a[:, None], got.shape), np.broadcast_to(b[:, None], got.shape)
            if best is not None:
                got, a, b = (np.concatenate(x) for x in ((best, got), (k1, a), (k2, b)))
            if len(got) > seeds:
                top = np.argpartition(-got, seeds - 1, axis=0)[:seeds]
                got, a, b = (np.take_along_axis(x, top, axis=0) for x in (got, a, b))
            best, k1, k2 = got, a, b
        if best is not None:
            row, item = np.nonzero(best > 0)
            yield _found(item, k1[row, item], k2[row, item], best[row, item])

    found = index.sketches.select("k1", "k2", "n", "coords", "codes").mapInArrow(run, FOUND)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "k1", "k2"))
    return found.groupBy("item", "k1", "k2").agg(F.max("bound").alias("bound")).withColumn(
        "r", rank).filter(F.col("r") <= seeds).drop("r")


def _reaching(index: Index, block: Block, thresholds: np.ndarray) -> DataFrame:
    """All texts whose bound is positive and reaches the item's threshold."""
    def run(batches):
        for a, b, *sketch in _sketch_chunks(batches):
            got = block.bounds(*sketch)
            row, item = np.nonzero((got > 0) & (got >= thresholds))
            yield _found(item, a[row], b[row], got[row, item])

    return index.sketches.select("k1", "k2", "n", "coords", "codes").mapInArrow(
        run, FOUND).groupBy("item", "k1", "k2").agg(F.max("bound").alias("bound"))


def _scored(texts: DataFrame, pairs: DataFrame, block: Block) -> DataFrame:
    """(item, k1, k2, score) of the pairs, scored on whole texts."""
    n_docs, length = block.documents, block.length
    wanted = pairs.groupBy("k1", "k2").agg(F.collect_set("item").alias("items"))
    wanted = F.broadcast(wanted) if pairs.count() <= BROADCAST_ROWS else wanted

    def run(batches):
        seen = set()
        for batch in slices(batches, 64):
            out = []
            for k1, k2, items, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                found = terms(text)
                counts = Counter(found)
                out += [(i, k1, k2, exact(counts, len(found), block.items[i], n_docs, length))
                        for i in items]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], t) for c, t in enumerate(
                    (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["item", "k1", "k2", "score"])

    return written(texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "items", "t").mapInArrow(
        run, "item int, k1 long, k2 long, score long").dropDuplicates(["item", "k1", "k2"]),
        "scored")


def _blocks(items: DataFrame, index: Index, id_col: str, text: str):
    """Items with a term of the corpus, block by block; only one block at a time
    is on the driver."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("t")).filter(
        "t is not null").distinct().orderBy("id", "t")

    def block(held: list) -> Block | None:
        words = sorted({t for _, c in held for t in c})
        known = spark.createDataFrame([(bytearray(t),) for t in words], "term binary")
        df = {bytes(r["term"]): r["df"] for r in index.lexicon.join(
            F.broadcast(known), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weights = {t: weight(index.documents, n) for t, n in df.items()}
        held = [(i, [(t, n * weights[t]) for t, n in c.items() if t in weights]) for i, c in held]
        held = [(i, ts) for i, ts in held if ts]
        if not held:
            return None
        table = WordHashes()
        coord = {t: table[t] % index.width for t in weights}
        coords = np.array(sorted(set(coord.values())), np.int64)
        matrix = np.zeros((len(coords), len(held)), np.float32)
        for k, (_, ts) in enumerate(held):
            for t, w in ts:
                matrix[np.searchsorted(coords, coord[t]), k] += w
        return Block([i for i, _ in held], [ts for _, ts in held], coords, matrix,
                     index.documents, index.length)

    held, distinct = [], set()
    for r in rows.toLocalIterator():
        counts = Counter(terms(r["t"]))
        if not counts:
            continue
        more = distinct | counts.keys()
        if held and (len(held) >= ITEMS or min(len(more), index.width) * (len(held) + 1) > CELLS):
            yield block(held)
            held, more = [], set(counts)
        held.append((r["id"], counts))
        distinct = more
    if held:
        yield block(held)


def search(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", top: int = TOP, seeds: int = SEEDS,
           width: int = WIDTH) -> DataFrame:
    """Per item its ``top`` highest-scoring rows of ``df`` with a score above 0:
    item id, rank from 1, document id, score; equal scores by rising id, rows
    without an id after those with one.

    Null and empty texts, and texts without a term, are found by nothing and
    count nowhere; items of that kind give no row. Each row of ``df`` counts and
    ranks by itself, repeated ids and texts too. An item that repeats as a whole
    counts once; different texts of one item id are ranked each by itself. Long
    texts count whole. Empty tables give no rows; other columns are ignored."""
    spark = df.sparkSession
    kinds = [df.schema[id_col].dataType.simpleString(),
             items.schema[item_id].dataType.simpleString()]
    out = f"`{item_id}` {kinds[1]}, rank int, `{id_col}` {kinds[0]}, score long"
    index = build_index(df, id_col=id_col, text=text, width=width)
    if not index.documents:
        return spark.createDataFrame([], out)
    texts = df.select(F.col(text).cast("string").alias("t")).filter("t is not null").select(
        *text_key("t"), "t")
    parts = []
    for block in _blocks(items, index, item_id, item_text):
        if block is None:
            continue
        first = _scored(texts, written(_highest(index, block, max(seeds, top)), "seeds"), block)
        limit = first.filter("score > 0").withColumn("r", F.row_number().over(
            Window.partitionBy("item").orderBy(F.desc("score")))).filter(F.col("r") == top)
        thresholds = np.zeros(len(block.items))
        for r in limit.select("item", "score").collect():
            thresholds[r["item"]] = r["score"]
        rest = written(_reaching(index, block, thresholds).join(
            first, ["item", "k1", "k2"], "left_anti"), "rest")
        scored = first.unionByName(_scored(texts, rest, block)).filter("score > 0")
        # Texts below the item's first ``top`` cannot rank; all of equal scores stay.
        best = scored.withColumn("r", F.rank().over(
            Window.partitionBy("item").orderBy(F.desc("score")))).filter(F.col("r") <= top)
        ranked = index.sketches.select("id", "k1", "k2").join(best.drop("r"), ["k1", "k2"]).withColumn(
            "rank", F.row_number().over(Window.partitionBy("item").orderBy(
                F.desc("score"), F.col("id").asc_nulls_last()))).filter(F.col("rank") <= top)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_key {kinds[1]}")
        parts.append(written(ranked.join(F.broadcast(ids), "item").select(
            F.col("item_key").alias(item_id), "rank", F.col("id").alias(id_col), "score"), "ranked"))
    if not parts:
        return spark.createDataFrame([], out)
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def oracle() -> str:
    """The same ranking in DuckDB SQL."""
    def tokens(table, key):
        return f"""SELECT {key}, unnest(regexp_extract_all(translate(text,
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {table} WHERE text IS NOT NULL"""
    return f"""
WITH t AS ({tokens("documents", "doc_id")}),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM t GROUP BY 1, 2),
len AS (SELECT doc_id, COUNT(*) AS n FROM t GROUP BY 1),
tot AS (SELECT COUNT(*) AS nd, SUM(n)::BIGINT AS l FROM len),
q AS (SELECT item_id, term, COUNT(*) AS qtf FROM ({tokens("benchmark", "item_id")}) GROUP BY 1, 2),
d AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
      FROM d, tot),
m AS (SELECT doc_id, 100 - 75 + (75 * n * nd) // l AS m FROM len, tot),
s AS (SELECT item_id, doc_id,
        CAST(SUM(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
        AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
