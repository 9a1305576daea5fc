"""Interpolated modified Kneser-Ney bigram model over words.

Counted in Spark: tasks count whole texts in blocks and send each bucket of
the hash space one compact blob per block; a bucket's task merges its blobs
into a sorted hash array and writes it to the shared folder. Workers map these
files into memory to score. Words are numbered by the rank of their hash, so a
pair (previous word, word) is one 64-bit key; keys are spread by an invertible
mix, so a frequent word loads no bucket more than others.

Files: words.<b> (hash, count), pairs.<b> (mixed key, count), and by word
number followers.<b> (total, kinds seen once, twice, thrice or more) and
before.<b> (distinct previous words).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import byte_slices, give_back, shared_dir, shuffle_partitions
from tickflow.llm.words import word_hashes

END = 0x9D5F_31C7_A0E4_26B3       # hash of the end token
BLOCK_TOKENS = 1_000_000          # tokens counted at a time in a task
BUCKET_TOKENS = 2_000_000         # training tokens a bucket may gather at most, on average
SLICE_BYTES = 1 << 20             # of a batch turned into Python texts at a time
BLOB_BYTES = 1 << 22              # of blobs handed over at a time
ROWS = 512
BLOB = "bucket int, kind string, size long, keys binary, counts binary"
U64 = np.uint64
M1, M2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53       # odd, so that they have inverses


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(M1)
    x = (x ^ (x >> U64(33))) * U64(M2)
    return x ^ (x >> U64(33))


def gather(x: np.ndarray) -> np.ndarray:
    """Inverse of ``spread``."""
    x = x ^ (x >> U64(33))
    x = x * U64(pow(M2, -1, 2**64))
    x = x ^ (x >> U64(33))
    x = x * U64(pow(M1, -1, 2**64))
    return x ^ (x >> U64(33))


# ------------------------------------------------------------ blobs and files

def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as 8 byte planes: planes of zeros compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(U64).ravel()


def steps(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U64(0)))


def unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=U64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else \
        np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first, axis=0) if len(keys) else counts


def blobs(kind: str, keys: np.ndarray, counts: np.ndarray, which: np.ndarray) -> Iterator[tuple]:
    """One blob per bucket of sorted keys; ``which`` is their bucket, ascending."""
    at = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1])))
    for a, b in zip(at, [*at[1:], len(keys)], strict=True):
        yield (int(which[a]), kind, b - a, steps(keys[a:b]),
               b"".join(pack(np.ascontiguousarray(c)) for c in counts[a:b].T))


def blob_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + len(row[4])
        if size >= BLOB_BYTES:
            yield blob_batch(held)
            held, size = [], 0
    if held:
        yield blob_batch(held)


def blob_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (
            pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
        names=["bucket", "kind", "size", "keys", "counts"])


def merged(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and summed counts of a bucket's blobs, unpacked one by one and merged
    with those of like size, so that few are whole at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for k, c, n in zip(table.column("keys"), table.column("counts"), table.column("size"),
                       strict=True):
        raw, n = c.as_buffer(), n.as_py()
        part = (unsteps(k.as_buffer()), np.stack([unpack(raw[i * 8 * n:(i + 1) * 8 * n])
                                                  for i in range(width)], axis=1))
        while held and len(held[-1][0]) <= 2 * len(part[0]):
            part = _sum_of(held.pop(), part)
        held.append(part)
    total = held.pop() if held else (np.empty(0, U64), np.empty((0, width), U64))
    while held:
        total = _sum_of(held.pop(), total)
    return total


def _sum_of(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1])))


def local_path(uri: str) -> str:
    """The shared folder as a path that workers can map into memory."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: the model's files are mapped into memory, so spark.checkpoint.dir "
                         "must be a folder mounted on all machines (file: or a plain path)")
    return parts.path


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole file or none, and the same bytes from any attempt of a task."""
    part = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(part, "wb") as f:
        np.save(f, np.ascontiguousarray(array))
    os.replace(part, os.path.join(folder, name))


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in the fewest bytes that hold the bucket's largest."""
    top = int(counts.max()) if counts.size else 0
    return counts.astype(np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else
                         np.uint32 if top < 2**32 else np.uint64)


class Files:
    """Memory-mapped arrays of a model folder."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def get(self, name: str) -> np.ndarray:
        if name not in self.open:
            path = os.path.join(self.folder, name)
            self.open[name] = np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else \
                np.load(path)
        return self.open[name]


class Words:
    """Word hash -> number and count, over words.<b>."""

    def __init__(self, folder: str, offsets: list[int]):
        self.files, self.offsets, self.n = Files(folder), offsets, len(offsets) - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each of sorted distinct hashes, -1 if unknown."""
        out = np.full(len(hashes), -1, np.int64)
        which = bucket_of(hashes, self.n)
        ends = np.searchsorted(which, np.arange(self.n + 1))
        for b in np.unique(which):
            part = hashes[ends[b]:ends[b + 1]]
            keys = self.files.get(f"words.{b}")
            if len(keys):
                at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
                out[ends[b]:ends[b + 1]] = np.where(keys[at] == part, at + self.offsets[b], -1)
        return out

    def by_number(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Rows of name.<b> at sorted numbers (all known)."""
        ends = np.searchsorted(numbers, self.offsets)
        parts = [self.files.get(f"{name}.{b}")[numbers[ends[b]:ends[b + 1]] - self.offsets[b]]
                 for b in range(self.n) if ends[b] < ends[b + 1]]
        return np.concatenate(parts).astype(np.float64) if parts else np.empty(0)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Ascending in the key: the hash space cut into n equal ranges."""
    return ((keys >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts, each closed by the end token, and the ends."""
    parts = []
    for t in texts:
        parts += [word_hashes(t or ""), np.array([END], U64)]
    flat = np.concatenate(parts) if parts else np.empty(0, U64)
    ends = np.cumsum([len(p) for p in parts])[1::2] if parts else np.empty(0, np.int64)
    return flat, ends


# ------------------------------------------------------------ counting

def _blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    texts, chars = [], 0
    for batch in byte_slices(batches, SLICE_BYTES):
        for t in batch.column(0).to_pylist():
            texts.append(t)
            chars += len(t or "")
            if chars >= 6 * BLOCK_TOKENS:
                yield tokens(texts)
                texts, chars = [], 0
    if texts:
        yield tokens(texts)


def _numbered(flat: np.ndarray, words: Words) -> np.ndarray:
    kinds, back = np.unique(flat, return_inverse=True)
    return words.numbers(kinds)[back]


def _pair_keys(ids: np.ndarray, ends: np.ndarray, n_words: int) -> np.ndarray:
    """(previous number, number) of each token as one key; the number after the
    last word's stands for a text's beginning. Unknown numbers must be masked."""
    prev = np.empty_like(ids)
    prev[1:] = ids[:-1]
    if len(ids):
        prev[0] = n_words
        prev[ends[:-1]] = n_words
    return (prev.astype(U64) << U64(32)) | ids.astype(U64)


def train(df: DataFrame, text: str = "text") -> dict:
    """Counts the texts of ``df`` and writes the model; returns its folder and
    totals. Only sums over buckets come back to the driver."""
    spark = df.sparkSession
    uri = shared_dir(spark, "ngram-model")
    folder = local_path(uri)
    os.makedirs(folder, exist_ok=True)
    texts = df.select(F.col(text).cast("string"))
    buckets = shuffle_partitions(spark)

    def count_words(batches):
        for flat, _ in _blocks(batches):
            keys, n = np.unique(flat, return_counts=True)
            yield from blob_batches(blobs("word", keys, n.astype(U64)[:, None],
                                          bucket_of(keys, buckets)))

    def save_words(key, table):
        b = key[0].as_py()
        keys, counts = merged(table, 1)
        save(folder, f"words.{b}", keys)
        save(folder, f"count.{b}", narrow(counts[:, 0]))
        return pa.table({"bucket": pa.array([b], pa.int32()), "n": pa.array([len(keys)]),
                         "total": pa.array([int(counts.sum())])})

    done = {r["bucket"]: r for r in texts.mapInArrow(count_words, BLOB).groupBy("bucket")
            .applyInArrow(save_words, "bucket int, n long, total long").collect()}
    for b in range(buckets):
        if b not in done:
            save(folder, f"words.{b}", np.empty(0, U64))
            save(folder, f"count.{b}", np.empty(0, np.uint8))
    offsets = [0]
    for b in range(buckets):
        offsets.append(offsets[-1] + (done[b]["n"] if b in done else 0))
    n_words, n_tokens = offsets[-1], sum(r["total"] for r in done.values())
    if n_words >= 2**32 - 1:
        raise ValueError("more than 2^32 - 2 distinct words")
    pair_buckets = max(buckets, -(-n_tokens // BUCKET_TOKENS))

    def count_pairs(batches):
        words = Words(folder, offsets)
        for flat, ends in _blocks(batches):
            keys, n = np.unique(spread(_pair_keys(_numbered(flat, words), ends, n_words)),
                                return_counts=True)
            yield from blob_batches(blobs("pair", keys, n.astype(U64)[:, None],
                                          bucket_of(keys, pair_buckets)))

    def save_pairs(key, table):
        b = key[0].as_py()
        keys, counts = merged(table, 1)
        counts = counts[:, 0]
        save(folder, f"pairs.{b}", keys)
        save(folder, f"pair_count.{b}", narrow(counts))
        plain = gather(keys)
        bounds = np.array(offsets[1:], np.int64)
        rows = []
        for kind, ids, cols in (
                ("followers", plain >> U64(32), np.stack(
                    [counts, counts == 1, counts == 2, counts >= 3], axis=1).astype(U64)),
                ("before", plain & U64(0xFFFFFFFF), np.ones((len(keys), 1), U64))):
            ids, sums = summed(ids, cols)
            rows += blobs(kind, ids, sums, np.searchsorted(bounds, ids.astype(np.int64), "right"))
        n = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        rows.append((-1, "ones", 0, b"", json.dumps(n).encode()))
        give_back()
        return pa.Table.from_batches([blob_batch(rows)])

    stats = texts.mapInArrow(count_pairs, BLOB).groupBy("bucket").applyInArrow(save_pairs, BLOB)
    # Written, so that the pair files are saved once and both uses read one result.
    stats.write.parquet(f"{uri}-stats")
    stats = spark.read.parquet(f"{uri}-stats")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{uri}-stats")
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)

    def save_stats(key, table):
        b = key[0].as_py()          # bucket len(offsets) - 1 is the beginning of texts
        out = {"bucket": pa.array([b], pa.int32())}
        size = offsets[b + 1] - offsets[b] if b < len(offsets) - 1 else 1
        for kind, width in (("followers", 4), ("before", 1)):
            part = table.filter(pa.compute.equal(table.column("kind"), kind))
            ids, sums = merged(part, width)
            full = np.zeros((size, width), U64)
            full[ids.astype(np.int64) - offsets[b]] = sums
            save(folder, f"{kind}.{b}", full if width > 1 else full[:, 0])
        seen = full[:, 0]
        ones = [int((seen == k).sum()) for k in (1, 2, 3, 4)] + [int((seen >= 3).sum()),
                                                                 int(seen.sum())]
        out["ones"] = pa.array([json.dumps(ones)])
        return pa.table(out)

    seen = stats.filter("bucket >= 0").groupBy("bucket").applyInArrow(
        save_stats, "bucket int, ones string").collect()
    pair_ones = np.array([json.loads(bytes(r["counts"])) for r in
                          stats.filter("bucket = -1").select("counts").collect()] or [[0] * 4])
    have = {r["bucket"] for r in seen}
    for b in range(buckets + 1):
        if b not in have:
            save(folder, f"followers.{b}", np.zeros((0 if b < buckets else 1, 4), U64))
            save(folder, f"before.{b}", np.zeros(0 if b < buckets else 1, U64))
    found = set(os.listdir(folder))
    for b in range(pair_buckets):
        if f"pairs.{b}" not in found:
            save(folder, f"pairs.{b}", np.empty(0, U64))
            save(folder, f"pair_count.{b}", np.empty(0, np.uint8))
    low = np.array([json.loads(r["ones"]) for r in seen] or [[0] * 6]).sum(axis=0)
    return {"folder": folder, "offsets": offsets, "tokens": int(n_tokens), "words": int(n_words),
            "pair_buckets": pair_buckets, "pair_discounts": discounts(pair_ones.sum(axis=0)),
            "word_discounts": discounts(low[:4]), "pairs_seen": int(low[5]),
            "word_ones": [int(low[0]), int(low[1]), int(low[4])]}


def discounts(n) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the
    numbers of kinds seen 1 to 4 times; each kept within [0, count]."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)):
        d = k - (k + 1) * y * b / a if a else 0.5
        out.append(min(max(d, 0.0), float(k)))
    return out


# ------------------------------------------------------------ scoring

class Model:
    def __init__(self, spec: dict):
        self.spec = spec
        self.words = Words(spec["folder"], spec["offsets"])
        self.pairs = Files(spec["folder"])
        d = spec["word_discounts"]
        self.total = max(spec["pairs_seen"], 1)
        held = sum(x * n for x, n in zip(d, spec["word_ones"], strict=True))
        # What discounting frees goes to all words and the unknown one alike.
        self.floor = (held / self.total if spec["pairs_seen"] else 1.0) / (spec["words"] + 1)

    @staticmethod
    def less(counts: np.ndarray, d: list[float]) -> np.ndarray:
        return np.maximum(counts - np.choose(np.clip(counts, 0, 3).astype(int), [0.0, *d]), 0.0)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct mixed keys."""
        n = self.spec["pair_buckets"]
        out = np.zeros(len(keys))
        which = bucket_of(keys, n)
        ends = np.searchsorted(which, np.arange(n + 1))
        for b in np.unique(which):
            have, part = self.pairs.get(f"pairs.{b}"), keys[ends[b]:ends[b + 1]]
            if len(have):
                at = np.minimum(np.searchsorted(have, part), len(have) - 1)
                hit = have[at] == part
                out[ends[b]:ends[b + 1]][hit] = self.pairs.get(f"pair_count.{b}")[at[hit]]
        return out

    def score(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, base score, log10 probability."""
        spec = self.spec
        flat, ends = tokens(texts)
        kinds, back = np.unique(flat, return_inverse=True)
        numbers = self.words.numbers(kinds)
        known = numbers >= 0
        at = numbers[known]                       # ascending, as the hashes are
        count, before = np.zeros(len(kinds)), np.zeros(len(kinds))
        follow = np.zeros((len(kinds), 4))
        if len(at):
            count[known] = self.words.by_number("count", at)
            before[known] = self.words.by_number("before", at)
            follow[known] = self.words.by_number("followers", at)
        n, v = spec["tokens"], spec["words"]
        base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
        low = self.less(before, spec["word_discounts"]) / self.total + self.floor
        d = spec["pair_discounts"]
        begin = np.array(self.words.files.get(f"followers.{len(spec['offsets']) - 1}"),
                         np.float64)
        follow = np.concatenate([follow, begin])   # row len(kinds): the beginning
        total = follow[:, 0]
        rest = np.where(total > 0, follow[:, 1:] @ np.array(d) / np.maximum(total, 1), 1.0)
        prev = np.empty(len(flat), np.int64)
        prev[1:] = back[:-1]
        prev[0] = prev[ends[:-1]] = len(kinds)
        ids = numbers[back]
        before_id = np.append(numbers, spec["words"])[prev]
        both = (ids >= 0) & (before_id >= 0)
        c = np.zeros(len(flat))
        keys = spread((before_id[both].astype(U64) << U64(32)) | ids[both].astype(U64))
        uniq, where = np.unique(keys, return_inverse=True)
        c[both] = self.pair_counts(uniq)[where]
        p = self.less(c, d) / np.maximum(total[prev], 1) + rest[prev] * low[back]
        starts = np.concatenate(([0], ends[:-1]))
        per = lambda x: np.add.reduceat(x, starts)
        return (ends - starts, per((count > 0)[back].astype(np.int64)), per(base[back]),
                per(np.log10(p)))


def held_out(id_col: str = "doc_id", parts: int = 10):
    """crc32 of the id as text leaves 0 (a row without an id is held out too)."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % parts == 0, F.lit(True))


def score(df: DataFrame, spec: dict, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        model = Model(spec)
        for batch in byte_slices(batches, 2 * SLICE_BYTES, ROWS):
            n, known, base, own = model.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                 pa.array(known, pa.int64()), pa.array([spec["tokens"]] * len(n), pa.int64()),
                 pa.array(base), pa.array(own)],
                names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                       "score"])

    return df.select(id_col, held_out(id_col).alias("held_out"),
                     F.col(text).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, "
             "train_tokens long, base_score double, score double")


def language_model_scores(df: DataFrame, *, id_col: str = "doc_id", text: str = "text"
                          ) -> DataFrame:
    """One row per input row: id, held_out, n_tokens (words and one end),
    n_known, train_tokens, base_score, score, both log10 of the whole text,
    with perplexity 10 ** (-score / n_tokens). Learns from rows that are not
    held out. A null or empty text is one end token; a null id is held out and
    scored; repeated rows count each; an empty table gives none and an empty
    training set scores every token as unknown; other columns are ignored."""
    spec = train(df.filter(~held_out(id_col)), text)
    return score(df, spec, id_col=id_col, text=text)
