"""Personal data by a semi-Markov conditional random field.

Base spans are what the four patterns below find. Beside them the text is cut
into zones: runs of number groups, or one e-mail-like string. A zone's atoms
are segmented jointly: dynamic programming over segments of at most
``MAX_ATOMS`` atoms chooses boundaries and kinds by the summed weights of
features of whole spans (digit count, check sum, separators, marks). Weights
are fitted on a bounded sample of zones that the base patterns label.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone")          # fixed order of the output
LABELS = (*KINDS, "other")
MAX_ATOMS = 8
SAMPLE_ZONES = 4000                                # bound of the fitting sample
SHAPE_ZONES, FIT_ZONES = 3, 600                    # zones of a shape, and in all, to learn from
SAMPLE_CHARS = 300                                 # longer zones are not sampled, but are searched

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Each run of digits is tried from its start only: a later start fails as it does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
DIGITS = re.compile(r"[0-9]+")

ATOM = re.compile(r"(?<![A-Za-z0-9_@])\+?\(?[0-9]++\)?(?![A-Za-z0-9_@])")
GAP = re.compile(r"[\x20.\-/]{0,3}\Z")
AT = re.compile(r"\x20?(?:@|[\[(]at[\])])\x20?")
SPELT = re.compile(r"[A-Za-z0-9-]+(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]+)+")

Span = tuple[int, int, int]                        # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            yield start, last
        else:
            last = at + 1          # no match starts at or before this sign
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start; spans that fail their check are dropped."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text)
                if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3
                       for p in m[0].split("."))]
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text)
                    if 8 <= sum(map(len, DIGITS.findall(m[0]))) <= 15]
    return out


# ---------------------------------------------------------------- zones

def zones(text: str) -> Iterator[list[tuple[int, int, bool]]]:
    """Runs of atoms (start, end, is_email) that one segment could join."""
    found = []
    if "@" in text or "at]" in text or "at)" in text:
        last = 0
        for m in AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            tail = SPELT.match(text, m.end()) if start < m.start() else None
            if tail:
                last = tail.end()
                found.append((start, last))
                yield [(start, last, True)]
    if not DIGIT.search(text):
        return
    zone, k = [], 0
    for m in ATOM.finditer(text):
        a, b = m.span()
        while k < len(found) and found[k][1] <= a:
            k += 1
        if k < len(found) and found[k][0] < b:
            continue                               # inside an e-mail
        if zone and not (a - zone[-1][1] <= 3 and GAP.match(text[zone[-1][1]:a])):
            yield zone
            zone = []
        zone.append((a, b, False))
    if zone:
        yield zone


# ---------------------------------------------------------------- features

FEATURES = ("bias", "check sum", "plus", "parenthesis", "one atom", "groups of four",
            "3-3-4 groups", "dots only", "spaces or dashes only", "mixed separators",
            "13 to 19 digits", "10 to 12 digits", "under 7 digits", "at sign spelt out")
# Prior means of the weights (the fit starts and is shrunk there).
PRIOR = {
    ("email", "bias"): 4.0, ("ip", "bias"): 3.0, ("ip", "dots only"): 2.0,
    ("card", "bias"): -1.0, ("card", "check sum"): 3.0, ("card", "13 to 19 digits"): 2.0,
    ("card", "groups of four"): 1.0, ("card", "plus"): -4.0, ("card", "parenthesis"): -4.0,
    ("phone", "bias"): -2.0, ("phone", "plus"): 4.0, ("phone", "parenthesis"): 2.0,
    ("phone", "3-3-4 groups"): 5.0, ("phone", "10 to 12 digits"): 2.0, ("phone", "one atom"): -2.0, ("phone", "dots only"): -2.0,
    ("phone", "mixed separators"): 0.5, ("phone", "under 7 digits"): -4.0, ("other", "bias"): 0.5,
    ("other", "under 7 digits"): 1.0, ("other", "plus"): -1.0,
}


def prior() -> np.ndarray:
    w = np.zeros((len(LABELS), len(FEATURES)))
    for (kind, name), v in PRIOR.items():
        w[LABELS.index(kind), FEATURES.index(name)] = v
    return w


def span_features(text: str, atoms, i: int, j: int) -> tuple[np.ndarray, list[int]]:
    """Features of the span over atoms i..j and the kinds it may have at all."""
    start, end = atoms[i][0], atoms[j][1]
    span = text[start:end]
    x = np.zeros(len(FEATURES))
    x[0] = 1
    x[4] = i == j
    if atoms[i][2]:
        x[13] = "@" not in span
        return x, [0, 4]
    groups = DIGITS.findall(span)
    digits = "".join(groups)
    n = len(digits)
    seps = [text[atoms[k][1]:atoms[k + 1][0]] for k in range(i, j)]
    dots, dashes = all(s == "." for s in seps), all(s in (" ", "-") for s in seps)
    plus, paren = "+" in span, "(" in span or ")" in span
    good = 13 <= n <= 19 and luhn(digits)
    sizes = [len(g) for g in groups]
    x[1], x[2], x[3] = good, span[0] == "+", paren
    x[5] = len(sizes) >= 4 and sizes[:3] == [4, 4, 4] and sizes[-1] <= 4
    x[6] = sizes[-3:] == [3, 3, 4] and len(sizes) <= 4
    if j > i:
        x[7], x[8] = dots, dashes and not dots
        x[9] = not (dots or dashes)
    x[10], x[11], x[12] = 13 <= n <= 19, 10 <= n <= 12, n < 7
    kinds = [4] if i == j else []
    if len(sizes) == 4 == j - i + 1 and dots and not plus and not paren and all(
            s <= 3 and int(g) <= 255 for s, g in zip(sizes, groups, strict=True)):
        kinds.append(1)
    if good and dashes and not plus and not paren:
        kinds.append(2)
    closed = span.count("(") == span.count(")") <= 1 and span[1:].count("+") == 0
    if 8 <= n <= 15 and closed and (x[2] or x[6] and 10 <= n <= 11):
        kinds.append(3)
    return x, kinds


def segments(text: str, atoms) -> list[tuple[int, int, int, np.ndarray]]:
    """(first atom, last atom, kind, features), ordered by last atom."""
    out = []
    for j in range(len(atoms)):
        for i in range(max(0, j - MAX_ATOMS + 1), j + 1):
            x, kinds = span_features(text, atoms, i, j)
            out += [(i, j, k, x) for k in kinds]
    return out


def decode(text: str, atoms, weights: np.ndarray) -> list[Span]:
    """Best segmentation of a zone; equal scores prefer the longer, earlier kind."""
    best, back = [0.0] + [float("-inf")] * len(atoms), [None] * (len(atoms) + 1)
    for i, j, k, x in segments(text, atoms):
        score = best[i] + float(weights[k] @ x)
        if score > best[j + 1]:
            best[j + 1], back[j + 1] = score, (i, k)
    spans, end = [], len(atoms)
    while end:
        i, k = back[end]
        if k < len(KINDS):
            spans.append((k, atoms[i][0], atoms[end - 1][1]))
        end = i
    return spans[::-1]


def find_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): the field adds spans that overlap no base span."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added, k, reach = [], 0, 0
    for atoms in sorted(zones(text)):
        for kind, a, b in decode(text, atoms, weights):
            while k < len(taken) and taken[k][0] < b:
                reach = max(reach, taken[k][1])
                k += 1
            if reach <= a:
                added.append((kind, a, b))
    return base, sorted([*base, *added])


# ---------------------------------------------------------------- fitting

def _labelled(text: str) -> Iterator[str]:
    """Zones whose atoms the base patterns label, as 'text|kind:i:j,...': those
    where every base span covers whole atoms, and no longer match was dropped."""
    base = base_spans(text)
    for atoms in zones(text):
        a, b = atoms[0][0], atoms[-1][1]
        if b - a > SAMPLE_CHARS:
            continue
        inside = [s for s in base if s[1] < b and s[2] > a]
        first = {x[0]: i for i, x in enumerate(atoms)}
        last = {x[1]: i for i, x in enumerate(atoms)}
        if any(s[1] not in first or s[2] not in last for s in inside):
            continue
        if not inside and (PHONE.search(text, a, b) or len(atoms) > 4):
            continue
        marks = ",".join(f"{k}:{first[s]}:{last[e]}" for k, s, e in sorted(
            inside, key=lambda s: s[1]))
        yield f"{text[a:b]}|{marks}"


def sample_zones(df: DataFrame, text: str = "text", limit: int = SAMPLE_ZONES) -> list[str]:
    """At most ``limit`` distinct labelled zones, lowest hashes first."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = {z for t in batch.column(0).to_pylist() for z in _labelled(t)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["zone"])

    found = (df.select(F.col(text).cast("string").alias("t"))
             .filter(F.col("t").rlike("[0-9@]")).mapInArrow(run, "zone string").distinct()
             .withColumn("h", F.xxhash64("zone")).orderBy("h", "zone").limit(limit))
    return [r["zone"] for r in found.select("zone").collect()]


def fit(sample: list[str], steps: int = 60, rate: float = 2.0, shrink: float = 0.002, *,
        per_shape: int = SHAPE_ZONES, limit: int = FIT_ZONES) -> np.ndarray:
    """Weights by gradient ascent on the conditional log-likelihood, shrunk
    towards the prior. Of the sample, the first ``per_shape`` zones of each
    shape (digits and small letters alike) are learned from, the shapes in the
    sample's order, ``limit`` zones in all. Neighbouring sample zones are also
    joined by a space, so that boundaries between entities are learned. No
    sample: the prior."""
    w = prior()
    cases = []

    def add(text, gold):
        atoms_list = list(zones(text))
        if len(atoms_list) != 1:
            return
        atoms = sorted(atoms_list[0])
        segs = segments(text, atoms)
        want, at = set(), 0
        for k, i, j in gold:
            want |= {(x, x, 4) for x in range(at, i)} | {(i, j, k)}
            at = j + 1
        want |= {(x, x, 4) for x in range(at, len(atoms))}
        hits = np.array([(i, j, k) in want for i, j, k, _ in segs])
        if hits.sum() == len(want):
            cases.append((segs, hits, len(atoms), np.array([s[3] for s in segs]),
                          np.array([s[2] for s in segs])))

    parsed = []
    for z in sample:
        text, _, marks = z.rpartition("|")
        parsed.append((text, [tuple(map(int, m.split(":"))) for m in marks.split(",") if m]))
    by_shape: dict = {}
    for text, gold in parsed:      # a few zones of each shape say as much as all of them
        by_shape.setdefault((re.sub("[a-z]+", "a", re.sub("[0-9]", "9", text)), tuple(gold)),
                            []).append((text, gold))
    parsed = [x for zones_of in by_shape.values() for x in zones_of[:per_shape]][:limit]
    for text, gold in parsed:
        add(text, gold)
    for (ta, ga), (tb, gb) in zip(parsed, parsed[1:] + parsed[:1], strict=True):
        za = list(zones(ta))
        if len(za) == 1 and ga and gb and not za[0][0][2]:
            n = len(za[0])
            add(f"{ta} {tb}", [*ga, *[(k, i + n, j + n) for k, i, j in gb]])
    if not cases:
        return w
    mean = prior()
    for _ in range(steps):
        grad = np.zeros_like(w)
        for segs, hits, n, xs, ks in cases:
            score = np.einsum("sf,sf->s", xs, w[ks])
            fwd, bwd = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
            fwd[0] = bwd[n] = 0
            for s, (i, j, _, _) in enumerate(segs):
                fwd[j + 1] = np.logaddexp(fwd[j + 1], fwd[i] + score[s])
            for s in range(len(segs) - 1, -1, -1):
                i, j = segs[s][:2]
                bwd[i] = np.logaddexp(bwd[i], score[s] + bwd[j + 1])
            p = np.array([np.exp(fwd[i] + score[s] + bwd[j + 1] - fwd[n])
                          for s, (i, j, _, _) in enumerate(segs)])
            np.add.at(grad, ks, (hits - p)[:, None] * xs)
        w += rate * (grad / len(cases) - shrink * (w - mean))
    return w


# ---------------------------------------------------------------- operators

def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(df: DataFrame, weights: np.ndarray | None = None, *, id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone (base spans of
    each kind), base_sha256, spans (base and added spans as kind:start:end by
    kind, then start; code points, end exclusive), n_added.

    A null text counts as empty and has no spans; null ids and repeated rows
    are kept; an empty table gives none; other columns are ignored. Weights are
    fitted on a sample of the same table unless given."""
    if weights is None:
        weights = fit(sample_zones(df, text))

    def make():
        def fn(ids, texts):
            counts, shas, listed, added = [[] for _ in KINDS], [], [], []
            for t in texts:
                base, spans = find_spans(t or "", weights)
                for k, c in enumerate(counts):
                    c.append(sum(s[0] == k for s in base))
                shas.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(spans))
                added.append(len(spans) - len(base))
            return [ids, *counts, shas, listed, added]
        return fn

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [F.col(id_col), F.col(text).cast("string")],
                    f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                    "base_sha256 string, spans string, n_added long", make)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span as [KIND]; of spans that overlap, one mark of the first kind."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, weights: np.ndarray | None = None, *, text: str = "text") -> DataFrame:
    """The table with every span of ``text`` replaced by [EMAIL], [IP], [CARD]
    or [PHONE]; all other columns as they are; null texts stay null."""
    if weights is None:
        weights = fit(sample_zones(df, text))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = [t if t is None else redacted(t, find_spans(t, weights)[1])
                   for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, pa.string()))

    return df.mapInArrow(run, df.schema)
