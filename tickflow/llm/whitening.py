"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x, stored once as blocks of rows. A pass over the
blocks takes a small matrix Q to V Q, V the covariance of x: each task adds up
Xc' (Xc Q) over its blocks, Xc centred before multiplying, and only these sums
(dimensions times columns of Q) leave it. The filter applies a Chebyshev
polynomial of V to the whole search space, one pass a degree; it damps what
lies between the least eigenvalue and the least Ritz value of the space. QR and
Rayleigh-Ritz follow, until the residuals of all wanted pairs certify them. A
Lanczos vector rides along the first passes and bounds the spectrum from below.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
GUARD = 8                 # columns of the search space beyond the wanted ones
DEGREE = 10               # passes between two Rayleigh-Ritz steps
CYCLES = 200              # Rayleigh-Ritz steps at most; then an error, no result
NARROW = 0.02             # the damped interval's width, as a share of what lies above, at least
APART = 30.0              # log of how far a filter may lift the largest above the last wanted one
CERTIFIED = 1e-14         # residual of a wanted pair, as a share of the largest eigenvalue
STALLED = 1e-11           # residuals that fall no more certify below this share
NO_VARIANCE = 1e-11       # eigenvalues of less than this share of the largest count as zero
BLOCK_BYTES = 1 << 21
DIRECT = 64               # partial sums that the driver adds itself
LARGEST = 2.0 ** 56       # entries from here on have no x in a long
BLOCKS = "ids {ids}, x binary"


def _grid(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


def blocks(df: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int]:
    """(id lists and x as int64 rows, dimensions) of the usable vectors."""
    v = F.col(vector).cast("array<double>")
    good = df.select(F.col(id_col).alias("id"), v.alias("v")).filter(
        F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(
            ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)), F.lit(False))))
    top = good.groupBy(F.size("v").alias("dims")).count().orderBy(
        F.desc("count"), F.desc("dims")).first()
    dims = top["dims"] if top else 0
    kind = f"array<{df.schema[id_col].dataType.simpleString()}>"
    rows = max(1, BLOCK_BYTES // (8 * max(dims, 1)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                x = _grid(part.column(1).flatten().to_numpy(zero_copy_only=False))
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    whole = good.filter((F.size("v") == dims) & (F.size("v") > 0))
    return written(whole.mapInArrow(run, BLOCKS.format(ids=kind)), "whitening-blocks"), dims


def _rows(batches, dims: int):
    for batch in batches:
        for raw in batch.column(batch.num_columns - 1):
            yield np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)


def totals(table: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """Rows, exact sum per dimension, largest spread of a dimension."""
    def run(batches):
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        least, most = np.full(dims, 2**62), np.full(dims, -2**62)
        for x in _rows(batches, dims):
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
                 pa.array([Decimal((int(h) << 32) + int(w)) for h, w in zip(high, low, strict=True)],
                          pa.decimal128(38, 0)), pa.array(least), pa.array(most)],
                names=["dim", "n", "total", "least", "most"])

    got = table.select("x").mapInArrow(
        run, "dim int, n long, total decimal(38,0), least long, most long").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most")).orderBy("dim").collect()
    if not got:
        return 0, [], 0
    return got[0]["n"], [int(r["total"]) for r in got], max(r["most"] - r["least"] for r in got)


class Centre:
    """n x - S of rows of x: in 64 bits where its range proves that it fits
    (wrapped products cancel), else in Python integers."""

    def __init__(self, n: int, sums: list[int], spread: int):
        self.n, self.sums = n, sums
        self.small = n * spread < 2**62
        self.square_small = len(sums) * (n * spread) ** 2 < 2**63

    def scaled(self, x: np.ndarray) -> np.ndarray:
        if self.small:
            low = np.array([s % 2**64 for s in self.sums], np.uint64).view(np.int64)
            return x * np.int64(self.n % 2**63) - low
        return x.astype(object) * self.n - np.array(self.sums, object)

    def floats(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact; null where it does not fit a long."""
        d = self.scaled(x)
        if self.square_small:
            return (d * d).sum(axis=1).tolist()
        return [v if v < 2**63 else None for v in
                ((d.astype(object) ** 2).sum(axis=1) if len(d) else [])]


def _add(raws: list, size: int) -> np.ndarray:
    total = np.zeros(size)
    for raw in raws:
        total += np.frombuffer(raw, np.float64)
    return total


def summed(table: DataFrame, size: int, dims: int, fn: Callable) -> np.ndarray:
    """Sum of ``fn(x)``, ``size`` doubles, over all blocks. Tasks add up theirs;
    the sums of many tasks are added in groups before they reach the driver."""
    def run(batches):
        total, some = np.zeros(size), False
        for x in _rows(batches, dims):
            total += fn(x)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())],
                                             names=["part"])

    parts = table.select("x").mapInArrow(run, "part binary")
    tasks = table.rdd.getNumPartitions()
    if tasks > DIRECT:
        def join(key, group):
            return pa.table({"part": pa.array([_add(group.column("part").to_pylist(), size)
                                               .tobytes()], pa.binary())})
        parts = parts.withColumn("g", F.spark_partition_id() % int(tasks ** 0.5)).groupBy(
            "g").applyInArrow(join, "part binary")
    return _add([r["part"] for r in parts.collect()], size)


def product(table: DataFrame, centre: Centre, q: np.ndarray) -> tuple[np.ndarray, float]:
    """(V q, trace of V): one pass."""
    dims, width = q.shape

    def part(x):
        c = centre.floats(x)
        return np.append((c.T @ (c @ q)).ravel(), np.vdot(c, c))

    total = summed(table, dims * width + 1, dims, part) / centre.n
    return total[:-1].reshape(dims, width), float(total[-1])


class Lanczos:
    """One vector of a three-term recurrence; ``least()`` is below the spectrum
    but for a vector that the start happens to miss."""

    def __init__(self, dims: int, rng):
        v = rng.standard_normal(dims)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def step(self, w: np.ndarray) -> None:
        self.alpha.append(float(w @ self.basis[-1]))
        for _ in range(2):
            for u in self.basis:
                w = w - (w @ u) * u
        self.beta.append(float(np.linalg.norm(w)))
        self.basis.append(w / self.beta[-1] if self.beta[-1] else w)

    def least(self) -> float:
        if not self.alpha:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:-1], 1) + np.diag(self.beta[:-1], -1)
        return max(0.0, float(np.linalg.eigvalsh(t)[0]) - self.beta[-1])


def interval(low: float, high: float, top: float) -> tuple[float, float]:
    """(middle, half width) of what the filter damps: [low, high], reaching lower
    where that is narrow, so that what lies above is not blown up beyond reason."""
    low = min(low, high - NARROW * (top - high))
    return (high + low) / 2, max((high - low) / 2, 1e-15 * abs(top), 1e-300)


def growth(value: float, mid: float, half: float) -> float:
    """Log of how much a degree lifts an eigenvalue above the damped interval."""
    return float(np.arccosh(max((value - mid) / half, 1.0)))


def filtered(times: Callable, x: np.ndarray, vx: np.ndarray, mid: float, half: float, top: float,
             degree: int) -> np.ndarray:
    """p(V) x, p the Chebyshev polynomial of ``degree`` that stays small on the
    interval and is scaled to about one at ``top``; ``vx`` is V x."""
    first = ratio = half / max(top - mid, half)
    y = (vx - mid * x) * (ratio / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - ratio)
        x, y = y, (times(y) - mid * y) * (2 * after / half) - ratio * after * x
        ratio = after
    return y


def components(times: Callable, dims: int, wanted: int, *, guard: int = GUARD,
               degree: int = DEGREE, seed: int = 12) -> tuple[np.ndarray, np.ndarray, dict]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of the
    matrix whose products ``times`` gives, with the passes and residuals. Leading
    pairs that are certified are kept as they are and projected out of the filter."""
    rng = np.random.default_rng(seed)
    width = min(dims, wanted + max(guard, wanted // 4))
    ride, passes, best, low = Lanczos(dims, rng), 0, np.inf, 0.0

    def step(y: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        if len(ride.alpha) < degree and width < dims:
            out = times(np.column_stack([y, ride.basis[-1]]))
            ride.step(out[:, -1])
            return out[:, :-1]
        return times(y)

    basis = rng.standard_normal((dims, width))
    for cycle in range(CYCLES):
        q = np.linalg.qr(basis)[0]
        vq = step(q)
        h = q.T @ vq
        values, u = np.linalg.eigh((h + h.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        top = max(float(values[0]), 0.0)
        real = values[:wanted] > NO_VARIANCE * top
        left = np.linalg.norm(vq - q * values, axis=0)[:wanted][real]
        worst = float(left.max() / top) if left.size else 0.0
        done = worst <= CERTIFIED or (worst <= STALLED and worst > best / 2)
        if done or width == dims:
            return (values[:wanted][real], q[:, :wanted][:, real],
                    {"passes": passes, "cycles": cycle + 1, "residual": worst})
        best = min(best, worst)
        if len(ride.alpha) >= degree:
            low = ride.least()
        kept = int(np.argmax(np.append(left > CERTIFIED * top, True)))
        fixed, top = q[:, :kept], float(values[kept])

        def without(y, fixed=fixed):
            return y - fixed @ (fixed.T @ y)

        mid, half = interval(min(low, float(values[-1])), float(values[-1]), top)
        apart = growth(top, mid, half) - growth(float(values[min(wanted, width) - 1]), mid, half)
        at_once = int(np.clip(APART / max(apart, 1e-9), 2, degree))
        basis = np.column_stack([fixed, filtered(
            lambda y, without=without: without(step(y)), without(q[:, kept:]),
            without(vq[:, kept:]), mid, half, top, at_once)])
    raise RuntimeError(f"no certified components after {CYCLES} Rayleigh-Ritz steps")


def whiten(df: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding",
           wanted: int = COMPONENTS) -> DataFrame:
    """Per usable row and component up to ``wanted``: id, component (1 for the
    largest variance), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds a null, a non-finite entry or one
    of 2^56 and more in size are left out, and so are vectors of another length
    than most (of equally common lengths the longest counts). Null and repeated
    ids and equal vectors are rows like others. Directions without variance
    give no component, so an empty table, one row or equal vectors give no rows.
    A deviation above a long is null. Other columns are ignored."""
    out = (f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, component int, n long, "
           "deviation long, whitened double, explained double, identity_error double")
    empty = df.sparkSession.createDataFrame([], out)
    table, dims = blocks(df, id_col, vector)
    if not dims:
        return empty
    n, sums, spread = totals(table, dims)
    if not spread:
        return empty
    centre, trace = Centre(n, sums, spread), [0.0]

    def times(q: np.ndarray) -> np.ndarray:
        y, trace[0] = product(table, centre, q)
        return y

    values, q, _ = components(times, dims, min(wanted, dims))
    k = len(values)
    turn = q / np.sqrt(values)

    def moments(x):
        z = centre.floats(x) @ turn
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    m = summed(table, k * k + k, dims, moments) / n
    cov = m[:k * k].reshape(k, k) - np.outer(m[k * k:], m[k * k:])
    error, share = float(np.abs(cov - np.eye(k)).max()), values / trace[0]

    def run(batches):
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)
                rows = len(x)
                take = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(take), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                     pa.array(np.full(rows * k, n)),
                     pa.array(centre.deviation(x), pa.int64()).take(take),
                     pa.array((centre.floats(x) @ turn).ravel()),
                     pa.array(np.tile(share, rows)), pa.array(np.full(rows * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return table.select("ids", "x").mapInArrow(run, out)
