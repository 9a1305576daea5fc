"""Benchmark passages in training texts, by BM25 over the test items.

The items' inverted index holds, per term, its postings (item, share of the
item's own score) and the largest share per block of items. Every training
text is cut into overlapping passages; a passage is a query for all items of
which it scores at least ``SCORE`` of the item's own score. Block sums of the
largest shares are taken for all passages at once and rule most blocks out;
block-max WAND walks the postings of what is left, and each item found is
verified: word triples of its question and of its answer must both occur.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import slices, written

K1, B = 1.2, 0.75
SCORE = 0.6               # share of an item's own score that a passage must reach
OVERLAP = 0.5             # share of triples of the question and of the answer
BLOCK = 4                 # items in a block
LEAST_WORDS = 32          # shortest half passage
PART_CHARS = 4_000_000    # item text in one index: larger benchmarks take several
CACHE_WORDS = 150_000


def bare(word: str) -> str:
    """The word without leading and trailing signs that are neither letters nor
    digits."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def words_of(text: str) -> list[str]:
    return [w for w in map(bare, unicodedata.normalize("NFC", text).lower().split()) if w]


def triples(words: list[str]) -> set[tuple]:
    n = min(3, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The last line is the answer; of a text of one line, the last third."""
    head, _, tail = text.strip().rpartition("\n")
    question, answer = words_of(head), words_of(tail)
    if question and answer:
        return question, answer
    words = [*question, *answer]
    cut = -(-2 * len(words) // 3)
    return words[:cut], words[cut:]


class Index:
    """Impacts are shares of the item's own score, so one threshold fits all."""

    def __init__(self, items: list[tuple[int, str]]):
        parts = [(i, *question_answer(t or "")) for i, t in items]
        parts = [(i, q, a) for i, q, a in parts if q or a]
        # Items of similar words and length stand together, so that a block's
        # largest impacts stay close to those of its items.
        parts.sort(key=lambda p: (len(p[1]) + len(p[2]), p[0]))
        common = Counter(w for _, q, a in parts for w in {*q, *a})
        order = self._chain([({*q, *a}) for _, q, a in parts], common)
        parts = [parts[k] for k in order]
        self.items = [i for i, _, _ in parts]
        self.tests = [(triples(q), triples(a)) for _, q, a in parts]
        self.longest = max((len(q) + len(a) for _, q, a in parts), default=0)
        n = len(parts)
        mean = sum(len(q) + len(a) for _, q, a in parts) / max(n, 1)
        self.terms: dict[str, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for k, (_, q, a) in enumerate(parts):
            tf = Counter([*q, *a])
            size = K1 * (1 - B + B * sum(tf.values()) / mean)
            gain = {w: math.log(1 + (n - common[w] + 0.5) / (common[w] + 0.5)) * c * (K1 + 1)
                    / (c + size) for w, c in tf.items()}
            own = sum(gain.values())
            for w, g in gain.items():
                t = self.terms.setdefault(w, len(self.terms))
                if t == len(postings):
                    postings.append([])
                postings[t].append((k, g / own))
        self.blocks = -(-n // BLOCK)
        self.most = np.zeros((len(postings), self.blocks), np.float32)
        self.postings: dict[tuple[int, int], tuple[list, list]] = {}   # of a term in a block
        for t, p in enumerate(postings):
            for k, gain in p:
                cell = self.postings.setdefault((t, k // BLOCK), ([], []))
                cell[0].append(k)
                cell[1].append(gain)
                self.most[t, k // BLOCK] = max(self.most[t, k // BLOCK],
                                               np.float32(gain * (1 + 1e-6)))

    @staticmethod
    def _chain(sets: list[set], common: Counter) -> list[int]:
        """Order by the items' most common word, then as given."""
        top = [max(s, key=lambda w: (common[w], w)) if s else "" for s in sets]
        return sorted(range(len(sets)), key=lambda k: (top[k], k))

    def wand(self, terms: np.ndarray, least: float, blocks: np.ndarray
             ) -> list[tuple[int, float]]:
        """Items scoring at least ``least``, by WAND within each of ``blocks``;
        block maxima have ruled the other blocks out."""
        found = []
        for block in blocks.tolist():
            most = self.most[terms, block]
            mine = np.flatnonzero(most)
            lists = [[*self.postings[t, block], m, 0] for t, m in zip(
                terms[mine].tolist(), most[mine].tolist(), strict=True)]
            end = (block + 1) * BLOCK
            while lists:
                lists.sort(key=lambda x: x[0][x[3]])
                total, pivot = 0.0, end
                for x in lists:            # first item that could reach the threshold
                    total += x[2]
                    if total >= least - 1e-6:
                        pivot = x[0][x[3]]
                        break
                score, rest = 0.0, []
                for x in lists:            # lists before the pivot skip to it
                    ids, gains, _, at = x
                    while at < len(ids) and ids[at] < pivot:
                        at += 1
                    if at < len(ids) and ids[at] == pivot:
                        score += gains[at]
                        at += 1
                    if at < len(ids):
                        x[3] = at
                        rest.append(x)
                if pivot < end and score >= least - 1e-9:
                    found.append((pivot, score))
                lists = rest
        return found


class TermNumbers(dict):
    """word as it stands -> number of its bare form, -1 if in no item."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        number = self[word] = self.terms.get(bare(word), -1)
        return number


class Finder:
    """Passages of texts against one index."""

    def __init__(self, index: Index):
        self.index = index
        self.half = max(LEAST_WORDS, index.longest)
        self.terms = TermNumbers(index.terms)

    def find(self, texts: list) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap), best passage
        of each pair."""
        index, half = self.index, self.half
        split, flat, first = [], [], [0]
        for t in texts:
            words = unicodedata.normalize("NFC", t).lower().split() if t else []
            split.append(words)
            flat += map(self.terms.__getitem__, words)
            first.append(len(flat))
        ids = np.array(flat, np.int64)
        first = np.array(first)
        sizes = np.diff(first)
        # Passage k of a text has words k * half to (k + 2) * half; a shorter
        # last passage that lies in the one before is left out.
        counts = np.where(sizes > 0, np.maximum(-(-sizes // half) - 1, 1), 0)
        starts = np.concatenate(([0], np.cumsum(counts)))
        at = np.flatnonzero(ids >= 0)
        doc = np.searchsorted(first, at, "right") - 1
        slot = (at - first[doc]) // half
        window = np.concatenate([starts[doc] + slot, starts[doc] + slot - 1])
        ok = np.concatenate([slot < counts[doc], slot >= 1])
        term = np.concatenate([ids[at], ids[at]])
        n = len(index.terms)
        keys = np.unique(window[ok] * n + term[ok])
        where, term = keys // n, keys % n
        if not len(keys):
            return []
        begin = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        best: dict[tuple[int, int], tuple] = {}
        step = 4096
        for a in range(0, len(begin), step):
            rows = begin[a:a + step]
            stop = begin[a + step] if a + step < len(begin) else len(keys)
            sums = np.add.reduceat(index.most[term[rows[0]:stop]], rows - rows[0], axis=0)
            hit = sums >= SCORE - 1e-5
            for r in np.flatnonzero(hit.any(axis=1)):
                lo = rows[r]
                hi = rows[r + 1] if r + 1 < len(rows) else stop
                found = index.wand(term[lo:hi], SCORE, np.flatnonzero(hit[r]))
                if not found:
                    continue
                w = where[lo]
                d = int(np.searchsorted(starts, w, "right")) - 1
                k = int(w - starts[d])
                passage = [x for x in map(bare, split[d][k * half:(k + 2) * half]) if x]
                seen = triples(passage) if len(passage) >= 3 else set()
                for item, score in found:
                    q, ans = (self.overlap(part, seen, passage) for part in index.tests[item])
                    if q >= OVERLAP and ans >= OVERLAP:
                        row = (d, index.items[item], score, q, ans)
                        key = row[:2]
                        if key not in best or row[2:] > best[key][2:]:
                            best[key] = row
        return list(best.values())

    @staticmethod
    def overlap(part: set, seen: set, passage: list[str]) -> float:
        """Share of the part's triples in the passage; an absent part is covered."""
        if not part:
            return 1.0
        if len(next(iter(part))) < 3:      # a part of one or two words
            n = len(next(iter(part)))
            seen = {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)}
        return len(part & seen) / len(part)


def leaks(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text"
          ) -> DataFrame:
    """One row per document and test item found in it: id, item_id, score
    (share of the item's own BM25 score), question_overlap, answer_overlap.

    Null and empty texts and items match nothing; a document that repeats gives
    a row each time, a repeated item one row per id; null ids are kept; an
    empty table on either side gives none; other columns are ignored. Items
    are indexed in parts of at most PART_CHARS characters (or one item), so
    what a task holds has a bound; each part meets all documents."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, item_id long, score double, question_overlap double, "
              "answer_overlap double")

    def search(shared) -> DataFrame:
        def run(batches):
            finder = Finder(shared.value)
            for batch in slices(batches):
                found = finder.find(batch.column(1).to_pylist())
                if found:
                    d, i, s, q, a = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(d)), pa.array(i, pa.int64()), pa.array(s),
                         pa.array(q), pa.array(a)],
                        names=[id_col, "item_id", "score", "question_overlap", "answer_overlap"])

        return df.select(id_col, F.col(text).cast("string")).mapInArrow(run, schema)

    found = None
    for shared, more in _indexes(items):
        part = search(shared)
        if more or found is not None:       # several parts: keep each one's result
            part = written(part, "leaks")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def _indexes(items: DataFrame):
    """(broadcast index, are there more) for parts of the items of at most
    PART_CHARS characters, or of one item."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.length("text") > 0).distinct().orderBy("item_id", "text")
    send = items.sparkSession.sparkContext.broadcast
    part, chars = [], 0
    for r in rows.toLocalIterator():
        if part and chars + len(r["text"]) > PART_CHARS:
            yield send(Index(part)), True
            part, chars = [], 0
        part.append((r["item_id"], r["text"]))
        chars += len(r["text"])
    if part:
        yield send(Index(part)), False


def clean(df: DataFrame, items: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text holds no test item, with all their columns,
    in a pass for each part of the items and without a shuffle."""
    def keep(rows: DataFrame, shared) -> DataFrame:
        def run(batches):
            finder = Finder(shared.value)
            for batch in slices(batches):
                at = batch.schema.get_field_index(text)
                bad = {f[0] for f in finder.find(batch.column(at).to_pylist())}
                yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)],
                                            pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    for shared, more in _indexes(items):
        df = keep(df, shared)
        if more:
            df = written(df, "clean")
    return df
