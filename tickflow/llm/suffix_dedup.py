"""Removal of byte strings that repeat within or between texts, by suffix arrays.

Shards are cut so that equal strings of ``length`` bytes meet in one. Every such
string holds an anchor, the least hashed of its ``k``-byte strings; a string and
its equal hold the same one. Anchors that occur once need no more. Around the
others lies a context of all strings that hold the anchor. Contexts of one
anchor that are equal as a whole repeat as a whole; one of each kind goes to the
anchor's shard, which is named by the anchor's least text and the place there,
so that a family of copies shares shards. A shard's contexts are joined to
segments, and its suffix array and permuted common prefixes tell which strings
also start elsewhere. Anchors of very many kinds of context are narrowed first
in ranges of the string's start, each counted by a hash of what its strings
share, down to single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import key_filter, mixed, shuffle_partitions, slices, written
from tickflow.llm.suffix_array import longest_repeats

LENGTH = 400
ANCHOR_SHARE = 0.32       # k as a share of the length
SPANS = ((256, 4096), (1024, 1024))   # kinds of context at most, bytes of a text to a shard
HOT_KINDS = 8192          # kinds of context of one anchor that a shard may hold
RANGES = 17               # ranges of starts that a hot anchor's strings are first counted by
BATCH_BYTES = 3 << 20     # segments of whole shards put into one suffix array
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
LOC = "k1 long, k2 int, pos int"
HEAVY = 2000              # a key in more than one of so many rows is joined by broadcast
UNIT_BITS = 24            # of a pivot: its place in units of 1024 bytes, below its text


class Hashes:
    """Hashes of byte ranges from running sums; powers grow with the longest text."""

    def __init__(self, seed: int = 13):
        self.letters = np.random.default_rng(seed).integers(1, 2**63, 256, U64) * U64(2) + U64(1)
        self.powers = self.inverse = np.ones(1, U64)

    def of(self, raw: np.ndarray) -> None:
        self.raw, n = raw, len(raw)
        if n > len(self.powers):
            size = max(n, 2 * len(self.powers), 1 << 14)
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 2**64))):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U64))
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(self.letters[raw] * self.powers[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of raw[start:end], start below the text's length."""
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start]
                     + (end - start).astype(U64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    out = x
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(hashes: Hashes, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) such that each string of ``length`` bytes holds one of
    its least hash. Equal hashes within half a string keep the first and last."""
    n, width = len(hashes.raw), length - k + 1
    at = np.arange(n - k + 1)
    h = hashes.ranges(at, at + k)
    edge = np.zeros(width - 1, U64)
    least = np.concatenate((edge, sliding_min(h, width), edge))
    # the largest of the minima that cover a place is its own hash where it is one
    pos = np.flatnonzero(~sliding_min(~least, width) == h)
    found = h[pos]
    half = max(width // 2, 1)
    order = np.lexsort((pos, pos // half, found))
    cell = np.stack((found[order], (pos // half)[order].astype(U64)))
    change = (cell[:, 1:] != cell[:, :-1]).any(axis=0)
    keep = np.sort(order[np.append(True, change) | np.append(change, True)])
    return pos[keep], found[keep]


def text_keys(raw) -> list:
    """95 bits of a text."""
    return [F.xxhash64(raw).alias("k1"), F.xxhash64(F.lit("second"), raw).bitwiseAND(
        F.lit(0x7FFFFFFF)).cast("int").alias("k2")]


def _raw(text) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def _anchor_rows(rows: DataFrame, length: int, k: int) -> DataFrame:
    """h, c (the context's hash), and the place; equal texts once a task."""
    reach = length - k

    def run(batches):
        hashes, seen = Hashes(), set()
        for batch in slices(batches):
            out = []
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2), strict=True):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                raw = _raw(text.as_buffer())
                hashes.of(raw)
                pos, h = anchors(hashes, length, k)
                a, b = np.maximum(pos - reach, 0), np.minimum(pos + length, len(raw))
                c = mixed(hashes.ranges(a, b) + (pos - a).astype(U64) * U64(BASE))
                out.append((h.view(np.int64), c.view(np.int64), np.full(len(h), k1),
                            np.full(len(h), k2, np.int32), pos.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
                    names=["h", "c", "k1", "k2", "pos"])

    return rows.select("k1", "k2", "raw").mapInArrow(run, f"h long, c long, {LOC}")


# ------------------------------------------------------------ shards

def joined(places: list[tuple[int, int, int]], size: int, length: int, k: int
           ) -> Iterator[tuple[int, int, int, int]]:
    """(shard, shard, start, end) of the contexts of (shard, shard, position)s of
    a text, those that overlap in a shard as one."""
    held = None
    for s1, s2, pos in sorted(places):
        a, b = max(pos - (length - k), 0), min(pos + length, size)
        if held and held[:2] == (s1, s2) and a <= held[3]:
            held = (s1, s2, held[2], max(held[3], b))
            continue
        if held:
            yield held
        held = (s1, s2, a, b)
    if held:
        yield held


def _segments(rows: DataFrame, places: DataFrame, length: int, k: int) -> DataFrame:
    """s1, s2, k1, k2, start, body of the contexts at ``places`` (s1, s2, k1, k2,
    pos). Only texts that hold one are shuffled, but for the key filter's errors."""
    wanted = written(places.groupBy("k1", "k2").agg(F.collect_set(
        F.struct("s1", "s2", "pos")).alias("places")), "suffix-places")
    maybe = key_filter(wanted, "k1")

    def run(batches):
        seen = set()
        for batch in slices(batches, 64):
            out = []
            for k1, k2, raw, found in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (k1, k2) not in seen:
                    seen.add((k1, k2))
                    out += [(s1, s2, k1, k2, a, raw[a:b]) for s1, s2, a, b in joined(
                        [(p["s1"], p["s2"], p["pos"]) for p in found], len(raw), length, k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=["s1", "s2", "k1", "k2", "start", "body"])

    return rows.filter(maybe("k1")).join(wanted, ["k1", "k2"]).select(
        "k1", "k2", "raw", "places").mapInArrow(
        run, "s1 long, s2 long, k1 long, k2 int, start int, body binary")


SPAN = "k1 long, k2 int, lo int, hi int"


def _spans(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in out], t) for i, t in enumerate(
            (pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["k1", "k2", "lo", "hi"])


def runs(at: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of whole numbers, ascending."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist(),
                    strict=True))


def repeats(segments: list[tuple[int, int, int, bytes]], length: int) -> list[tuple]:
    """(k1, k2, first, last start) of the strings of ``length`` bytes that start at
    two places or more of the segments (k1, k2, start, body). Segments of one text
    that overlap are joined, so that no place counts twice."""
    whole: list[list] = []
    for k1, k2, start, body in sorted(segments, key=lambda r: (r[:3], -len(r[3]))):
        if whole and whole[-1][:2] == [k1, k2] and start <= whole[-1][2] + len(whole[-1][3]):
            more = start + len(body) - whole[-1][2] - len(whole[-1][3])
            if more > 0:
                whole[-1][3] += body[-more:]
        else:
            whole.append([k1, k2, start, bytearray(body)])
    if not whole:
        return []
    # 0 ends the text, a symbol of its own ends each segment, bytes lie above them
    n, size = len(whole), [len(w[3]) for w in whole]
    ends = np.cumsum(np.array(size) + 1)
    s = np.zeros(int(ends[-1]) + 1, np.int32)
    s[ends - 1] = np.arange(1, n + 1)
    bodies = np.ones(len(s), bool)
    bodies[ends - 1] = bodies[-1] = False
    s[bodies] = np.frombuffer(b"".join(bytes(w[3]) for w in whole), np.uint8).astype(
        np.int32) + (n + 1)
    good = np.flatnonzero(longest_repeats(s) >= length)
    out = []
    begins = ends - 1 - np.array(size)
    cuts = np.searchsorted(good, ends)
    for i, (k1, k2, start, _) in enumerate(whole):
        part = good[cuts[i - 1] if i else 0:cuts[i]]
        out += [(k1, k2, start + a - int(begins[i]), start + b - int(begins[i]))
                for a, b in runs(part)]
    return out


def _shard_spans(segments: DataFrame, length: int) -> DataFrame:
    """Repeated starts of each text in the segments: whole shards are put into
    suffix arrays of about ``BATCH_BYTES``."""
    def run(batches):
        held, size, last = [], 0, None
        for batch in slices(batches):
            for s1, s2, k1, k2, start, body in zip(*[c.to_pylist() for c in batch.columns],
                                                   strict=True):
                if (s1, s2) != last and size >= BATCH_BYTES:
                    yield _spans(repeats(held, length))
                    held, size = [], 0
                last = (s1, s2)
                held.append((k1, k2, start, body))
                size += len(body)
        yield _spans(repeats(held, length))

    n = shuffle_partitions(segments.sparkSession)
    return segments.repartition(n, "s1", "s2").sortWithinPartitions("s1", "s2").mapInArrow(run, SPAN)


# ------------------------------------------------------------ hot anchors

CORE = "h long, part int, w1 long, w2 long, k1 long, k2 int, pos int"


def _cores(contexts: DataFrame, length: int, k: int, width: int) -> DataFrame:
    """One row per context and range of ``width`` ways for a string to start before
    the anchor: two hashes of what all strings of the range share. ``parts``, if
    not null, are the wider ranges left."""
    reach = length - k
    wider = -(-(reach + 1) // RANGES)

    def run(batches):
        one, two = Hashes(), Hashes(14)
        for batch in slices(batches):
            out = []
            for h, pos, k1, k2, start, body, parts in zip(
                    *[c.to_pylist() for c in batch.columns], strict=True):
                raw = _raw(body)
                one.of(raw)
                two.of(raw)
                low, high = pos + length - start - len(raw), pos - start   # starts before it
                lo = np.arange(0, reach + 1, width)
                lo = lo[(lo <= high) & (lo + width - 1 >= low)]
                if parts is not None:
                    lo = lo[np.isin(lo // wider, parts)]
                hi = np.minimum(lo + width - 1, reach)
                a, b = pos - start - lo, pos - start - hi + length
                m = len(lo)
                out.append((np.full(m, h), lo // width, one.ranges(a, b).view(np.int64),
                            two.ranges(a, b).view(np.int64), np.full(m, k1), np.full(m, k2),
                            np.full(m, pos)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(t)) for x, t in zip(
                        zip(*out, strict=True), ("i8", "i4", "i8", "i8", "i8", "i4", "i4"),
                        strict=True)], names=[c.split()[0] for c in CORE.split(", ")])

    return contexts.select("h", "pos", "k1", "k2", "start", "body", "parts").mapInArrow(run, CORE)


def _repeated_cores(cores: DataFrame) -> DataFrame:
    """The cores that stand at two places or more."""
    cores = written(cores, "suffix-cores")
    key = ["h", "part", "w1", "w2"]
    place = F.xxhash64("k1", "k2", "pos")
    twice = cores.groupBy(*key).agg(F.min(place).alias("a"), F.max(place).alias("b")).filter(
        "a != b").drop("a", "b")
    return cores.join(twice, key)


def _hot_spans(rows: DataFrame, hot: DataFrame, length: int, k: int) -> DataFrame:
    """Repeated strings that hold a hot anchor (h, k1, k2, pos): contexts by
    ranges, then single strings in the ranges left. All counts are added up
    before they are shuffled, so no anchor is one task's work."""
    places = hot.select(F.col("h").alias("s1"), F.col("pos").cast("long").alias("s2"),
                        "k1", "k2", "pos")
    contexts = written(_segments(rows, places, length, k).select(
        F.col("s1").alias("h"), F.col("s2").cast("int").alias("pos"), "k1", "k2", "start", "body"),
        "suffix-contexts")
    wider = -(-(length - k + 1) // RANGES)
    key = ["h", "k1", "k2", "pos"]
    left = _repeated_cores(_cores(contexts.withColumn(
        "parts", F.lit(None).cast("array<int>")), length, k, wider)).groupBy(*key).agg(
        F.collect_set("part").alias("parts"))
    found = _repeated_cores(_cores(contexts.join(left, key), length, k, 1))
    start = F.col("pos") - F.col("part")
    return found.select("k1", "k2", start.alias("lo"), start.alias("hi")).distinct()


# ------------------------------------------------------------ the operator

def _with_counts(many: DataFrame, few: DataFrame, key: list[str]) -> DataFrame:
    """``many`` joined with its keys' rows ``few``, which hold the count ``n`` of
    their rows in ``many``. At most ``HEAVY`` keys can hold one of ``HEAVY`` rows
    each; they are sent to all tasks, so that no key's rows meet in one."""
    limit = -(-many.count() // HEAVY)
    few = written(few, "suffix-keys")
    heavy, light = F.broadcast(few.filter(F.col("n") > limit)), few.filter(F.col("n") <= limit)
    return many.join(heavy, key).unionByName(
        many.join(heavy.select(*key), key, "left_anti").join(light, key)).drop("n")



def repeated_starts(rows: DataFrame, length: int, k: int, *, hot_kinds: int = HOT_KINDS
                    ) -> DataFrame:
    """k1, k2, and array<struct<lo, hi>> of the starts whose string of ``length``
    bytes also starts elsewhere, for texts that have any; ``hi`` may pass the last
    start. ``rows``: k1, k2, raw, texts of ``length`` bytes or more."""
    loc = F.xxhash64("k1", "k2", "pos")
    found = written(_anchor_rows(rows, length, k), "suffix-anchors")
    unit = F.least(F.shiftright("pos", 10).cast("long"), F.lit((1 << UNIT_BITS) - 1))
    pivot = F.shiftleft(F.shiftright("k1", UNIT_BITS), UNIT_BITS).bitwiseOR(unit)
    shared = found.groupBy("h").agg(F.min(loc).alias("a"), F.max(loc).alias("b"),
                                    F.min(pivot).alias("pivot"), F.count("*").alias("n"))
    shared = written(_with_counts(found, shared.filter("a != b").select("h", "pivot", "n"), ["h"]),
                     "suffix-shared")
    kinds = shared.groupBy("h", "c").agg(F.min(loc).alias("a"), F.max(loc).alias("b"),
                                         F.count("*").alias("n"))
    kinds = written(kinds, "suffix-kinds")
    many = kinds.groupBy("h").agg(F.count("*").alias("kinds"))
    classes = written(_with_counts(shared, kinds.join(many, "h"), ["h", "c"]).select(
        "h", "k1", "k2", "pos", "pivot", "kinds", (F.col("a") != F.col("b")).alias("twice"),
        (loc == F.col("a")).alias("stands")), "suffix-classes")

    spans = classes.filter("twice").select(
        "k1", "k2", F.greatest(F.col("pos") - (length - k), F.lit(0)).alias("lo"),
        F.col("pos").alias("hi"))
    copies = rows.groupBy("k1", "k2").count().filter("count > 1").select(
        "k1", "k2", F.lit(0).alias("lo"), F.lit(2**31 - 1).alias("hi"))

    text, place = F.shiftright("pivot", UNIT_BITS), F.col("pivot").bitwiseAND((1 << UNIT_BITS) - 1)
    s1, s2 = F.col("h"), F.lit(-1)
    for i, (most, span) in reversed(list(enumerate(SPANS))):
        s1 = F.when(F.col("kinds") <= most, text).otherwise(s1)
        s2 = F.when(F.col("kinds") <= most, F.floor(place / (span // 1024)) * 2 + i).otherwise(s2)
    stand = classes.filter("stands and kinds > 1")
    shards = stand.filter(F.col("kinds") <= hot_kinds).select(
        s1.alias("s1"), s2.cast("long").alias("s2"), "k1", "k2", "pos")
    spans = spans.unionByName(copies).unionByName(
        _shard_spans(_segments(rows, shards, length, k), length))
    hot = stand.filter(F.col("kinds") > hot_kinds).select("h", "k1", "k2", "pos")
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(rows, hot, length, k))
    return written(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")),
                   "suffix-spans")


def kept_parts(raw: bytes, spans: list[tuple[int, int]], length: int) -> tuple[int, int, list]:
    """(bytes removed, maximal removed runs, parts kept) for ranges of starts."""
    removed = count = at = 0
    parts = []
    for lo, hi in sorted(spans):
        a, b = lo, min(hi + length, len(raw))
        if a > at or not count:
            parts.append(raw[at:a])
            count += 1
            at = a
        if b > at:
            removed += b - at
            at = b
    return removed, count, [*parts, raw[at:]]


def without_repeats(df: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                    length: int = LENGTH, hot_kinds: int = HOT_KINDS, keep_text: bool = False
                    ) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256 of what is left of the UTF-8 text once each byte is removed that a
    string of ``length`` bytes covers which also starts anywhere else; with
    ``keep_text`` also ``kept``, those bytes.

    A null text is empty; texts of fewer bytes are whole. Rows are texts of their
    own, also where ids or whole rows repeat; null ids stay. Matches never cross
    rows. Long texts count whole; an empty table gives no rows; other columns are
    ignored."""
    if length < 4:
        raise ValueError("length must be 4 bytes or more")
    k = max(2, round(ANCHOR_SHARE * length))
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("id"), raw.alias("raw")).select(
        "id", *text_keys("raw"), "raw")
    long_rows = rows.filter(F.octet_length("raw") >= length)
    spans = repeated_starts(long_rows, length, k, hot_kinds=hot_kinds)
    maybe = key_filter(spans, "k1")
    flagged = rows.withColumn("maybe", maybe("k1") & (F.octet_length("raw") >= length))
    kind = df.schema[id_col].dataType.simpleString()
    body = ", kept binary" if keep_text else ""

    def run(batches):
        for batch in slices(batches, 64):
            out = []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                  strict=True):
                removed, count, parts = kept_parts(
                    raw, [(s["lo"], s["hi"]) for s in spans or []], length)
                left = b"".join(parts)
                out.append((len(raw), removed, count, hashlib.sha256(left).hexdigest(), left))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(cols if keep_text else cols[:-1])],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       *(["kept"] if keep_text else [])])

    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{body}"
    cut = flagged.filter("maybe").join(spans, ["k1", "k2"], "left").select(
        "id", "raw", "spans").mapInArrow(run, schema)
    whole = flagged.filter("not maybe").select(
        "id", F.octet_length("raw").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias(
            "n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("raw", 256).alias("kept_sha256"), *([F.col("raw").alias("kept")] if keep_text else []))
    return cut.unionByName(whole).withColumnRenamed("id", id_col)
