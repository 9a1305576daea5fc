"""Toxicity by a bidirectional gated recurrent network, trained in numpy.

A word enters as its own hashed embedding beside the mean of its hashed
character n-gram embeddings. A forward and a backward GRU read a window of
words, attention pools their states, and a logistic unit scores the window; a
text's score is that of its highest window. Windows overlap and cover the
whole text. Training sees only the label of a text, so its gradient runs
through the highest window.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import process_cache, slices

WINDOW, STRIDE = 48, 36           # words in a window, words between window starts
HIDDEN = 8                        # units of each direction
WORD_DIM, CHAR_DIM = 6, 10
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 14
GRAMS = (3, 4, 5)
SAMPLE_TEXTS = 1000               # labelled texts a class at most, before the length bound
SAMPLE_CHARS = 6000               # longer texts are not learned from (all are scored)
EPOCHS, BATCH, RATE = 5, 32, 0.02
LEAST_STEPS = 300                 # a small sample is gone through more often
THRESHOLD = 0.3
CACHE_WORDS = 100_000
TOKENS = 24_000                  # words scored at a time


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the words' own embeddings; rows of their n-grams, one line per
    n-gram size and one column per byte of the padded words (CHAR_ROWS where no
    n-gram starts); each word's first column; each word's number of n-grams.
    Signs at a word's end are no part of it."""
    clean = [(w.lower().rstrip(".,;:!?\"')]}") or w).encode() for w in words]
    own = np.array([xxhash.xxh32_intdigest(w, 7) % WORD_ROWS for w in clean], np.int64)
    size = np.array([len(w) + 2 for w in clean], np.int64)
    end = np.cumsum(size)
    start = end - size
    text = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in clean]) + bytes(max(GRAMS)),
                         np.uint8).astype(np.uint32)
    at, last = np.arange(len(text) - max(GRAMS)), np.repeat(end, size)
    rows = np.empty((len(GRAMS), len(at)), np.int64)
    for line, n in enumerate(GRAMS):
        h = np.full(len(at), n, np.uint32)
        for k in range(n):
            h = h * np.uint32(0x01000193) + text[k:k + len(at)]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
        rows[line] = np.where(at + n <= last, h % np.uint32(CHAR_ROWS), CHAR_ROWS)
    count = sum(np.maximum(size - n + 1, 0) for n in GRAMS)
    return own, rows, start, count


def embed(p: dict, words: list[str]) -> np.ndarray:
    """Inputs of the words: own embedding and mean of the n-grams'."""
    own, rows, start, count = features(words)
    char = np.concatenate([p["char"], np.zeros((1, CHAR_DIM), np.float32)])
    total = sum(np.add.reduceat(char[line], start) for line in rows)
    return np.concatenate([p["word"][own], total / count[:, None]], axis=1).astype(np.float32)


def scatter(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct positions and the sums of their values."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[first], np.add.reduceat(values[order], first)


def windows(n: int) -> list[tuple[int, int]]:
    """Overlapping windows over n words; one empty window for a text without."""
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(a, a + WINDOW) for a in starts]


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def init(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d = WORD_DIM + CHAR_DIM

    def some(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    p = {"word": some(WORD_ROWS, WORD_DIM, scale=0.1), "char": some(CHAR_ROWS, CHAR_DIM, scale=0.3)}
    for way in "fb":
        p[f"W{way}"] = some(d, 3 * HIDDEN, scale=0.4)
        p[f"U{way}"] = some(HIDDEN, 3 * HIDDEN, scale=0.3)
        p[f"c{way}"] = np.zeros(3 * HIDDEN, np.float32)
    p["A"], p["v"] = some(2 * HIDDEN, HIDDEN, scale=0.4), some(HIDDEN, scale=0.4)
    p["out"], p["bias"] = some(2 * HIDDEN, scale=0.4), np.full(1, -1.0, np.float32)
    return p


def run_gru(x: np.ndarray, u: np.ndarray, mask: np.ndarray, back: bool):
    """States of a GRU over x (time, windows, 3 * HIDDEN: update, reset and
    candidate inputs); a masked step keeps its state."""
    steps, n = x.shape[:2]
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    kept = []
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        zr = sigmoid(x[t, :, :2 * HIDDEN] + h @ u[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        g = np.tanh(x[t, :, 2 * HIDDEN:] + (r * h) @ u[:, 2 * HIDDEN:])
        m = mask[t][:, None]
        new = h + m * z * (g - h)
        kept.append((t, h, z, r, g))
        h = out[t] = new
    return out, kept


def gru_grad(d_out, kept, u, mask):
    """Gradients of inputs and of u from those of the states."""
    n = d_out.shape[1]
    d_x, d_u = np.zeros((len(d_out), n, 3 * HIDDEN), np.float32), np.zeros_like(u)
    d_h = np.zeros((n, HIDDEN), np.float32)
    for t, h, z, r, g in reversed(kept):
        d = d_out[t] + d_h
        m = mask[t][:, None]
        d_z, d_g = d * m * (g - h) * z * (1 - z), d * m * z * (1 - g * g)
        d_rh = d_g @ u[:, 2 * HIDDEN:].T
        d_r = d_rh * h * r * (1 - r)
        d_zr = np.concatenate([d_z, d_r], axis=1)
        d_h = d * (1 - m * z) + d_rh * r + d_zr @ u[:, :2 * HIDDEN].T
        d_u[:, :2 * HIDDEN] += h.T @ d_zr
        d_u[:, 2 * HIDDEN:] += (r * h).T @ d_g
        d_x[t] = np.concatenate([d_zr, d_g], axis=1)
    return d_x, d_u


def forward(p, xf, xb, mask):
    """Window logits from the gate inputs of both directions."""
    hf, kf = run_gru(xf, p["Uf"], mask, False)
    hb, kb = run_gru(xb, p["Ub"], mask, True)
    h = np.concatenate([hf, hb], axis=2)
    q = np.tanh(h @ p["A"])
    e = np.where(mask > 0, q @ p["v"], -1e9)
    a = np.exp(e - e.max(axis=0)) * mask
    a /= np.maximum(a.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", a, h)
    return pooled @ p["out"] + p["bias"][0], (kf, kb, h, q, a, pooled)


def layout(n_words: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of the windows of texts laid end to end."""
    start, size, text, at = [], [], [], 0
    for k, n in enumerate(n_words):
        for a, b in windows(n):
            start.append(at + a)
            size.append(b - a)
            text.append(k)
        at += n
    return np.array(start, np.int64), np.array(size, np.int64), np.array(text, np.int64)


def grid(start, size):
    """Word positions (time, windows) and mask; masked positions point at 0."""
    t = np.arange(max(1, int(size.max(initial=0))))[:, None]
    mask = t < size[None, :]
    return np.where(mask, start[None, :] + t, 0), mask.astype(np.float32)


def train(texts: list[str], labels: list[int], *, epochs: int | None = None, seed: int = 3) -> dict:
    """Parameters fitted by Adam on texts of either label. Without both labels
    nothing can be learned and the initial parameters come back."""
    p = init(seed)
    if len(set(labels)) < 2:
        return p
    if epochs is None:
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    empty = max(1, len(texts) // 100)          # a text without words is clean
    texts, labels = [*texts, *[""] * empty], [*labels, *[0] * empty]
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in t.split()], np.int64)
            for t in texts]
    word_row, rows, start, count = features(list(vocab))
    owner = np.repeat(np.arange(len(vocab)), np.diff(np.append(start, rows.shape[1])))
    grams = [(line[line < CHAR_ROWS], owner[line < CHAR_ROWS]) for line in rows]
    order = np.argsort(np.concatenate([o for _, o in grams]), kind="stable")
    gram = np.concatenate([r for r, _ in grams])[order]
    gram_start = np.concatenate(([0], np.cumsum(count)))
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(docs), BATCH):
            pick = order[a:a + BATCH]
            used, place = np.unique(np.concatenate([docs[k] for k in pick]), return_inverse=True)
            if not len(used):
                continue
            size = count[used]
            first = np.cumsum(size) - size
            rows = gram[np.repeat(gram_start[used] - first, size) + np.arange(size.sum())]
            emb = np.concatenate([p["word"][word_row[used]], np.add.reduceat(
                p["char"][rows], first) / size[:, None]], axis=1).astype(np.float32)
            start, length, text = layout([len(docs[k]) for k in pick])
            at, mask = grid(start, length)
            at = place[at]
            x = emb[at]
            xf, xb = x @ p["Wf"] + p["cf"], x @ p["Wb"] + p["cb"]
            logit, (kf, kb, h, q, att, pooled) = forward(p, xf, xb, mask)
            best = np.array([i[np.argmax(logit[i])] for i in np.split(
                np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1)])
            d_logit = np.zeros(len(logit), np.float32)
            d_logit[best] = (sigmoid(logit[best]) - y[pick]) * weight[pick] / len(pick)
            g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
            d_pool = d_logit[:, None] * p["out"]
            d_a = np.einsum("nh,tnh->tn", d_pool, h)
            d_e = att * (d_a - (att * d_a).sum(axis=0))
            d_q = d_e[:, :, None] * p["v"] * (1 - q * q)
            g["v"] = np.einsum("tn,tnh->h", d_e, q)
            g["A"] = np.einsum("tni,tnj->ij", h, d_q)
            d_h = att[:, :, None] * d_pool + d_q @ p["A"].T
            d_xf, g["Uf"] = gru_grad(d_h[:, :, :HIDDEN], kf, p["Uf"], mask)
            d_xb, g["Ub"] = gru_grad(d_h[:, :, HIDDEN:], kb, p["Ub"], mask)
            d_in = 0
            for way, d_x in (("f", d_xf), ("b", d_xb)):
                g[f"W{way}"] = np.einsum("tni,tnj->ij", x, d_x)
                g[f"c{way}"] = d_x.sum(axis=(0, 1))
                d_in = d_in + d_x @ p[f"W{way}"].T
            d_emb = np.zeros_like(emb)
            where, sums = scatter(at.ravel(), d_in.reshape(-1, emb.shape[1]))
            d_emb[where] = sums
            step += 1
            rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            d_char = np.repeat(d_emb[:, WORD_DIM:] / size[:, None], size, axis=0)
            for k, at, d in (("word", word_row[used], d_emb[:, :WORD_DIM]), ("char", rows, d_char)):
                at, d = scatter(at, d)      # only rows in use move
                _adam(p[k], m1[k], m2[k], d, rate, at)
            for k, d in g.items():
                _adam(p[k], m1[k], m2[k], d, rate, slice(None))
    return p


def _adam(w, m1, m2, d, rate, rows):
    m1[rows] = 0.9 * m1[rows] + 0.1 * d
    m2[rows] = 0.999 * m2[rows] + 0.001 * d * d
    w[rows] -= rate * m1[rows] / (np.sqrt(m2[rows]) + 1e-8)


class Gates(dict):
    """word -> row of the table of gate inputs of both directions."""

    def __init__(self, p):
        super().__init__()
        self.p = p
        self.table = np.empty((CACHE_WORDS, 6 * HIDDEN), np.float32)
        self.w = np.concatenate([p["Wf"], p["Wb"]], axis=1)
        self.c = np.concatenate([p["cf"], p["cb"]])

    def add(self, words: list[str]) -> None:
        """New words, as many as there is room for."""
        emb = embed(self.p, words)
        n = len(self)
        self.table[n:n + len(words)] = emb @ self.w + self.c
        self.update(zip(words, range(n, n + len(words)), strict=True))

    def rows(self, words: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        except KeyError:
            new = [w for w in dict.fromkeys(words) if w not in self]
            if len(self) + len(new) > CACHE_WORDS:
                self.clear()
                new = list(dict.fromkeys(words))
            self.add(new)
            return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Scorer:
    def __init__(self, p: dict):
        self.p, self.gates = p, Gates(p)

    def logits(self, rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        at, mask = grid(start, size)
        x = self.gates.table[rows[at]] if len(rows) else np.zeros(
            (*at.shape, 6 * HIDDEN), np.float32)
        return forward(self.p, x[:, :, :3 * HIDDEN], x[:, :, 3 * HIDDEN:], mask)[0]

    def long_text(self, words: list[str]) -> float:
        """Highest window of one text of any length, in parts that overlap."""
        best, step = -np.inf, TOKENS // STRIDE * STRIDE
        for a in range(0, max(len(words) - WINDOW, 0) + 1, step):
            part = words[a:a + step + WINDOW]
            start, size, _ = layout([len(part)])
            best = max(best, float(self.logits(self.gates.rows(part), start, size).max()))
        return best

    def score(self, texts: list) -> np.ndarray:
        """Chance that each text is toxic: its highest window's. Texts are taken
        by length so that short ones share windows of their own size."""
        words = [(t or "").split() for t in texts]
        out, order = np.empty(len(texts)), sorted(range(len(texts)), key=lambda k: len(words[k]))
        part, total = [], 0

        def flush():
            nonlocal part, total
            if part:
                flat = [w for k in part for w in words[k]]
                start, size, text = layout([len(words[k]) for k in part])
                logit = self.logits(self.gates.rows(flat), start, size)
                best = np.full(len(part), -np.inf)
                np.maximum.at(best, text, logit)
                out[part] = best
            part, total = [], 0

        for k in order:
            if len(words[k]) > TOKENS:
                out[k] = self.long_text(words[k])
                continue
            if total + len(words[k]) > TOKENS:
                flush()
            part.append(k)
            total += len(words[k])
        flush()
        return 1 / (1 + np.exp(-out))


# ------------------------------------------------------------ Spark

def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text leaves 2 of 4 (false without an id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text"
           ) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: of each label the SAMPLE_TEXTS ids that
    hash lowest among those not held out, without texts over SAMPLE_CHARS. Of an
    id's texts the least counts, so the sample depends on the rows alone."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")
                          ).filter(F.col("_id").isNotNull() & ~held_out("_id")).distinct()
    parts = [known.filter(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id")
             .limit(SAMPLE_TEXTS) for y in (0, 1)]
    ids = F.broadcast(parts[0].unionByName(parts[1]))       # 2 * SAMPLE_TEXTS rows at most
    rows = (df.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
            .join(ids, "_id").filter(F.length("_text").between(1, SAMPLE_CHARS))
            .groupBy("_id", "_toxic").agg(F.min("_text").alias("_text"))
            .orderBy("_id", "_toxic").limit(2 * SAMPLE_TEXTS).collect())
    return [r["_text"] for r in rows], [r["_toxic"] for r in rows]


def _scorer(df: DataFrame, labels, params, id_col, text):
    """``make()`` for tasks: the scorer of given parameters, or of ones trained
    on a bounded sample of labelled rows of the same table."""
    if params is None:
        params = train(*sample(df, labels, id_col=id_col, text=text))
    shared, version = df.sparkSession.sparkContext.broadcast(params), uuid.uuid4().hex
    return lambda: process_cache("toxicity", lambda: Scorer(shared.value), version)


def toxicity(df: DataFrame, labels: DataFrame | None = None, params: dict | None = None, *,
             id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1), predicted (1 if
    score >= THRESHOLD).

    A null or empty text is one empty window; a null id is not held out, is
    never learned from and is scored; repeated rows score alike; an empty table
    gives none; other columns are ignored. Parameters are trained on a bounded
    sample of labelled rows of the same table unless given."""
    make = _scorer(df, labels, params, id_col, text)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        scorer = make()
        for batch in slices(batches):
            s = scorer.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s),
                 pa.array((s >= THRESHOLD).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"])

    return df.select(id_col, held_out(id_col).alias("held_out"),
                     F.col(text).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def without_toxic(df: DataFrame, labels: DataFrame | None = None, params: dict | None = None, *,
                  id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that ``toxicity`` does not predict toxic, with all
    their columns, in one pass and without a shuffle."""
    make = _scorer(df, labels, params, id_col, text)

    def run(batches):
        scorer = make()
        for batch in slices(batches):
            at = batch.schema.get_field_index(text)
            yield batch.filter(pa.array(scorer.score(batch.column(at).to_pylist()) < THRESHOLD))

    return df.mapInArrow(run, df.schema)
