"""Global ordering primitives without a single-partition window.

``Window.orderBy(ts)`` with no partition moves the whole table into one task.
Both helpers here cut the order into ``n`` slices instead: the slice bounds
are ``n - 1`` approximate quantiles of the leading order column (a list whose
size is fixed by ``n``), each row's slice is a pure function of its own value
(a binary search: a nested CASE for small ``n``, MLlib's Bucketizer for large),
so every branch of the plan that recomputes it agrees.
Only per-slice counts/totals are combined across slices; each row adds its
slice's offset to a local rank / running total computed inside the slice.

A slice holds about 1/n of the rows whatever the key skew, because the bounds
come from the data's own distribution.

When one aggregate job measures every group at or under ``MAX_GROUP_ROWS``
rows, the plain window is used instead: its task size is then proven by the
measurement, and it needs one shuffle instead of three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tickflow.operators.names import any_names
from tickflow.session import stage


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


# Largest group one window task may hold when that size has been measured.
# Above it (or unmeasured) the slice/halo plans run; both give equal results.
MAX_GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group of ``keys`` (one partial+final aggregate job;
    only a single number reaches the driver)."""
    if keys:
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"))
    else:
        g = df.agg(F.count(F.lit(1)))
    return int(g.first()[0] or 0)


def fits_one_task(df: DataFrame, keys: Sequence[str], limit: int | None) -> bool:
    """True when every group is measured to hold at most ``limit`` rows."""
    return limit is not None and limit > 0 and largest_group(df, keys) <= limit


# Rows a slice should hold; the slice count follows the measured row count.
SLICE_ROWS = 1_000_000


def slice_count(df: DataFrame, partitions: int | None = None) -> int:
    """Slices of at most about SLICE_ROWS rows, at least one per shuffle
    partition (one count job unless ``partitions`` is given)."""
    if partitions:
        return partitions
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return max(n, -(-df.count() // SLICE_ROWS))


def _numeric(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(t, DateType):
        return F.unix_date(F.col(col)).cast("double")
    return F.col(col).cast("double")


def _search(c: Column, bounds: list[float], base: int) -> Column:
    """Index of the slice holding ``c``: number of bounds <= c (binary search)."""
    if not bounds:
        return F.lit(base)
    mid = len(bounds) // 2
    return F.when(c < F.lit(bounds[mid]), _search(c, bounds[:mid], base)).otherwise(
        _search(c, bounds[mid + 1:], base + mid + 1))


# Above this many bounds the slice lookup uses MLlib's Bucketizer (a JVM
# binary search over a splits array) instead of a nested CASE expression,
# whose size grows with the bound count.
CASE_LIMIT = 512


def with_slice(df: DataFrame, col: str, n: int, out: str = "_pid",
               rel_err: float | None = None) -> DataFrame:
    """Adds a deterministic slice id (0..n-1, nulls -1) from quantile bounds
    of ``col``. Runs one approximate-quantile job now; the bounds are at most
    ``n - 1`` numbers."""
    num = _numeric(df, col)
    if n <= 1:
        return df.withColumn(out, F.when(num.isNull(), F.lit(-1)).otherwise(F.lit(0)))
    probe = df.select(num.alias("_o"))
    bounds = sorted(set(probe.approxQuantile("_o", [i / n for i in range(1, n)],
                                              rel_err or min(0.001, 0.25 / n))))
    if len(bounds) <= CASE_LIMIT:
        return df.withColumn(out, F.when(num.isNull(), F.lit(-1)).otherwise(
            _search(num, bounds, 0)))
    from pyspark.ml.feature import Bucketizer
    splits = [float("-inf"), *bounds, float("inf")]
    # Nulls go first (-1) and NaN last (Bucketizer's extra bucket), matching
    # Spark's ascending sort order, as the CASE form does.
    b = Bucketizer(splits=splits, inputCol="_num", outputCol="_bkt", handleInvalid="keep")
    return (b.transform(df.withColumn("_num", num))
            .withColumn(out, F.when(F.col("_num").isNull(), F.lit(-1))
                        .otherwise(F.col("_bkt").cast("int")))
            .drop("_num", "_bkt"))


@any_names
def dense_index(df: DataFrame, order: Sequence[str], *, keys=(), out: str = "idx",
                partitions: int | None = None,
                max_group_rows: int | None = MAX_GROUP_ROWS,
                stage_input: bool = True) -> DataFrame:
    """WIN-8: dense 0-based position of each row within its series by ``order``.

    Replaces ``monotonically_increasing_id`` (not dense, partition-dependent)
    and ``row_number() over (order by ...)`` (one task). ``order`` should end
    in a unique column so the numbering is reproducible; its first column
    (numeric or time) defines the slices.

    Plan: slice id -> local row_number per (slice, series) -> count table
    (one row per slice and series) -> per-series running offsets -> join on
    (slice, series). The local window and the join share one hash
    partitioning, so the big side is shuffled once.

    The input is read by up to three jobs (size check, quantiles, main
    pass); with ``stage_input`` it is checkpointed first so upstream work
    (scan, bar aggregation) runs once.
    """
    k, o = _keys(keys), list(order)
    if stage_input:
        df = stage(df)
    if fits_one_task(df, k, max_group_rows):
        w = Window.partitionBy(*k).orderBy(*o)
        return df.withColumn(out, (F.row_number().over(w) - F.lit(1)).cast("long"))
    n = slice_count(df, partitions)
    series = F.struct(*[F.col(c) for c in k]) if k else F.lit(0)
    r = with_slice(df, o[0], n).withColumn("_series", series)
    local = r.withColumn("_local", F.row_number().over(
        Window.partitionBy("_pid", "_series").orderBy(*o)) - F.lit(1))
    # Counts come from the windowed frame itself: it is already clustered by
    # (slice, series), so the count needs no shuffle and shares its exchange.
    counts = local.groupBy("_pid", "_series").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_series").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_series", F.coalesce(
        F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, ["_pid", "_series"])
            .select(*df.columns, (F.col("_local") + F.col("_off")).cast("long").alias(out)))


@any_names
def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str], *,
                   suffix: str = "_cum", partitions: int | None = None,
                   max_group_rows: int | None = MAX_GROUP_ROWS,
                   stage_input: bool = True) -> DataFrame:
    """Global running sums of ``values`` in ``order`` (inclusive of the row).

    The offset table has one row per slice, a size fixed by ``partitions``,
    so broadcasting it is bounded by construction. The input is checkpointed
    first (``stage_input``) since several jobs read it."""
    o, v = list(order), list(values)
    if stage_input:
        df = stage(df)
    if fits_one_task(df, [], max_group_rows):
        w = Window.orderBy(*o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(*df.columns, *[F.sum(c).over(w).alias(f"{c}{suffix}") for c in v])
    n = slice_count(df, partitions)
    r = with_slice(df, o[0], n)
    w = Window.partitionBy("_pid").orderBy(*o).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = r.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in v])
    # Totals from the windowed frame: already clustered by slice, no shuffle.
    totals = local.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in v])
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[
        F.coalesce(F.sum(f"_t_{c}").over(prior), F.lit(0)).alias(f"_o_{c}") for c in v])
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.select(*df.columns, *[
        (F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"{c}{suffix}") for c in v])
