"""Rolling time-window sums (JON-1 + AGG-2, WIN-4).

* ``rolling_sum`` (WIN-4), two exact plans:
  - halo: time cut into buckets as wide as the span, every row also copied
    into the next bucket; inside each (series, bucket) partition the frame
    sum is the difference of two running RANGE-frame totals. One shuffle;
    a partition holds two buckets of one series (bounded for bars).
  - slices: skew-proof for raw ticks; running totals over quantile time
    slices and an as-of lookup of the total before each frame's lower edge.
  ``method="auto"`` picks the halo plan when its partitions are proven (bar
  width) or measured to be bounded.
* ``rolling_join`` (JON-1 / AGG-2, the reference's self-join form): an
  equi-join on (series, bucket): buckets wholly inside a row's frame join as
  pre-summed rows, the two boundary buckets row by row with the range
  predicate; then one group per left row. Never a nested-loop join.

Q13: ``closed="right"`` gives the half-open ``(t - span, t]`` of the join form;
``closed="both"`` the closed ``[t - span, t]`` of the RANGE form. Sums are
decimals of 18 places in every plan and step, so all plans and any
partitioning agree bit for bit. Finite values of 10^12 or more are summed in
further decimals, one per tier of ten decades that the input holds (found by
one job). Only a frame that holds NaN or an infinity sums to NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.change import (EXACT, TIER, exact, in_tier, tier, tier_scale,
                                       unbounded)
from tickflow.functions.temporal import duration_seconds, epoch_micros, minus
from tickflow.operators.bars import bar_width_of
from tickflow.operators.index import MAX_GROUP_ROWS, fits_one_task, slice_count, with_slice
from tickflow.operators.joins import join_null_safe
from tickflow.operators.names import any_names
from tickflow.session import stage


MAX_BUCKET_ROWS = 20_000      # rows of a series that may meet row by row in a bucket


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _lower(span_us: int, closed: str) -> int:
    if closed == "both":
        return -span_us
    if closed == "right":
        return -span_us + 1
    raise ValueError("closed must be 'right' or 'both'")


def _tiers(df: DataFrame, value: str) -> list[int]:
    """The tiers of large finite values that the input holds, mostly none."""
    n = tier(F.col(value))
    return sorted(r[0] for r in df.filter(n > 0).select(n.alias("n")).distinct().collect())


def _parts(value: str, tiers: list[int]) -> list[tuple]:
    """(name, column, type) of all that a frame sums: the exact decimal, one
    decimal per tier, and the count of NaN and infinite values."""
    v = F.col(value)
    return [("_w0", exact(v), EXACT), *((f"_w{n}", in_tier(v, n), TIER) for n in tiers),
            ("_odd", unbounded(v), "long")]


def _total(sums: dict, tiers: list[int]):
    """A frame's sum as a double; NaN where the frame holds NaN or an infinity."""
    total = sums["_w0"].cast("double")
    for n in tiers:
        total = total + sums[f"_w{n}"].cast("double") * F.lit(tier_scale(n))
    return F.when(sums["_odd"] > 0, F.lit(float("nan"))).otherwise(total)


def _with_halo(df: DataFrame, ts: str, width_us: int, copies: int = 1) -> DataFrame:
    """Each row in its own time bucket plus ``copies`` later buckets (halo)."""
    us = epoch_micros(F.col(ts))
    b = F.floor(us / F.lit(width_us))
    arr = F.array(*[F.struct((b + i).alias("b"), F.lit(i > 0).alias("h"))
                    for i in range(copies + 1)])
    out = df.select("*", us.alias("_us"), F.explode(arr).alias("_x"))
    return out.select("*", F.col("_x.b").alias("_b"), F.col("_x.h").alias("_halo")).drop("_x")


@any_names
def rolling_sum(df: DataFrame, value: str, span: str = "24 hours", *, keys=("symbol",),
                ts: str = "timestamp", out: str | None = None,
                closed: str = "both", method: str = "auto",
                max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """WIN-4: sum of ``value`` over the trailing ``span`` of each row.

    ``method="halo"``: (series, time bucket) partitions with a one-bucket
    halo; the frame sum is the difference of two running totals inside the
    partition (both incremental, O(n)); a sliding RANGE frame would re-add
    the whole frame for every row. One shuffle, but a partition holds two
    buckets of one series, so it suits bars (bounded by span/width).

    ``method="slices"``: skew-proof for raw ticks, where one series may hold
    a large share of all rows in a day. See ``_rolling_sum_sliced``.

    ``method="auto"`` uses the halo plan when two buckets are known to fit
    ``max_group_rows``: proven from the bar width for tagged bars, else
    measured with one aggregate job; otherwise the sliced plan. All give the
    same exact (decimal) result."""
    k = _keys(keys)
    span_us = duration_seconds(span) * 1_000_000
    lo = _lower(span_us, closed)
    if method not in ("auto", "halo", "slices"):
        raise ValueError("method must be 'auto', 'halo' or 'slices'")
    staged = method == "auto"
    if method == "auto":
        limit = None if max_group_rows is None else max_group_rows // 2
        width = bar_width_of(df, ts, k)
        df = stage(df)
        if width and limit is not None and span_us // 1_000_000 // width + 1 <= limit:
            method = "halo"          # bars: a bucket holds at most span/width rows
        else:
            bucket = F.floor(epoch_micros(F.col(ts)) / F.lit(span_us))
            method = "halo" if fits_one_task(df.withColumn("_bk", bucket), [*k, "_bk"],
                                             limit) else "slices"
    if method == "slices":
        return _rolling_sum_sliced(df, value, lo, k, ts, out or f"{value}_sum")
    if not staged:
        df = stage(df)
    tiers = _tiers(df, value)
    u = _with_halo(df, ts, span_us)
    w = Window.partitionBy(*k, "_b").orderBy("_us")
    def framed(v, zero):
        upto = F.sum(v).over(w.rangeBetween(Window.unboundedPreceding, 0)).cast(zero)
        before = F.sum(v).over(w.rangeBetween(Window.unboundedPreceding, lo - 1)).cast(zero)
        return upto - F.coalesce(before, F.lit(0).cast(zero))

    total = _total({name: framed(v, kind) for name, v, kind in _parts(value, tiers)}, tiers)
    return (u.select("*", total.alias(out or f"{value}_sum"))
            .filter(~F.col("_halo")).drop("_us", "_b", "_halo"))


def _rolling_sum_sliced(df: DataFrame, value: str, lo: int, k: list[str], ts: str,
                        out: str) -> DataFrame:
    """Rolling sum without any per-series partition.

    1. Rows are summed per (series, time) (duplicates collapse map-side).
    2. For each such point at time t a lookup key t + lo is added: the frame
       excludes exactly the points before it.
    3. Points and lookups are cut into quantile time slices; inside a
       (slice, series) partition a running sum over (time, points after
       lookups) gives each point its local running total and each lookup the
       local total of the points before it; per-slice totals (one row per
       slice and series) give each partition its offset. So every point gets
       C(t) and every lookup C(before t + lo).
    4. frame sum = C(t) - C(before t + lo), joined back to the rows.
    A slice holds about 1/n of all points whatever the series skew."""
    base = stage(df.withColumn("_us", epoch_micros(F.col(ts))))
    tiers = _tiers(base, value)
    parts = _parts(value, tiers)
    names = [name for name, _, _ in parts]
    kinds = {name: kind for name, _, kind in parts}
    pts = base.groupBy(*k, "_us").agg(*[F.sum(v).cast(kind).alias(name)
                                        for name, v, kind in parts])
    marks = (pts.select(*k, F.col("_us").alias("_t"), F.lit(1).alias("_kind"), *names,
                        F.col("_us").alias("_at"))
             .unionByName(pts.select(*k, (F.col("_us") + F.lit(lo)).alias("_t"),
                                     F.lit(0).alias("_kind"),
                                     *[F.lit(0).cast(kinds[c]).alias(c) for c in names],
                                     F.col("_us").alias("_at"))))
    marks = stage(marks)
    n = slice_count(marks)
    series = F.struct(*[F.col(c) for c in k]) if k else F.lit(0)
    r = with_slice(marks, "_t", n).withColumn("_series", series)
    w = (Window.partitionBy("_pid", "_series").orderBy("_t", "_kind")
         .rowsBetween(Window.unboundedPreceding, 0))

    def zero(c):
        return F.lit(0).cast(kinds[c])

    some = {c: F.coalesce(F.col(c), zero(c)) for c in names}
    local = r.withColumns({f"_l{c}": F.sum(some[c]).over(w).cast(kinds[c]) for c in names})
    totals = local.groupBy("_pid", "_series").agg(*[
        F.sum(some[c]).cast(kinds[c]).alias(f"_t{c}") for c in names])
    prior = Window.partitionBy("_series").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", "_series", *[
        F.coalesce(F.sum(f"_t{c}").over(prior).cast(kinds[c]), zero(c)).alias(f"_f{c}")
        for c in names])
    c = local.join(offsets, ["_pid", "_series"]).withColumns({
        f"_c{x}": (F.col(f"_l{x}") + F.col(f"_f{x}")).cast(kinds[x]) for x in names})
    upto = c.filter(F.col("_kind") == 1).select(*k, F.col("_at").alias("_us"),
                                                *[f"_c{x}" for x in names])
    before = c.filter(F.col("_kind") == 0).select(*k, F.col("_at").alias("_us"),
                                                   *[F.col(f"_c{x}").alias(f"_b{x}")
                                                     for x in names])
    frame = join_null_safe(upto, before, [*k, "_us"]).select(
        *k, "_us", _total({x: F.col(f"_c{x}") - F.col(f"_b{x}") for x in names},
                          tiers).alias(out))
    return join_null_safe(base, frame, [*k, "_us"]).drop("_us")



@any_names
def rolling_join(df: DataFrame, value: str, span: str = "24 hours", *, keys=("symbol",),
                 ts: str = "timestamp", carry=("price",), out: str | None = None,
                 closed: str = "right", buckets_per_span: int = 8,
                 stage_input: bool = True) -> DataFrame:
    """JON-1 + AGG-2: left-outer range self-join, then one group per left row.

    Time is cut into buckets of span/``buckets_per_span``. For each left row,
    the buckets lying wholly inside its frame join as one pre-summed row each
    (equi-join on (series, bucket) against a per-bucket aggregate); only the
    two boundary buckets join row by row with the range predicate. Each left
    row thus meets about ``buckets_per_span`` bucket sums plus two buckets of
    rows, instead of every row of its frame, and never a nested loop. Sums
    are exact decimals, so the split does not change the result.
    Meant for bars (a bucket holds at most bucket/width rows per series); for
    raw ticks use ``rolling_sum``. Both join sides read the input, so it is
    staged first (``stage_input``). Input whose time column carries no bar width
    is measured first: buckets of more than ``MAX_BUCKET_ROWS`` rows of a series
    would meet row by row, so they raise and ask for ``rolling_sum``.
    Output: keys, ts, carried left columns, the summed right ``value``."""
    k = _keys(keys)
    if stage_input:
        df = stage(df)
    span_us = duration_seconds(span) * 1_000_000
    width = max(span_us // buckets_per_span, 1)
    if not bar_width_of(df, ts, k) and not fits_one_task(
            df.withColumn("_bk", F.floor(epoch_micros(F.col(ts)) / F.lit(width))), [*k, "_bk"],
            MAX_BUCKET_ROWS):
        raise ValueError(f"a time bucket of one series holds more than {MAX_BUCKET_ROWS} rows; "
                         "use rolling_sum for raw ticks")
    lo = _lower(span_us, closed)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    us = epoch_micros(F.col(ts))
    # The frame's first microsecond: the span before the row, or just after it.
    first = epoch_micros(minus(F.col(ts), span)) + F.lit(lo + span_us)
    left = df.select(*k, ts, *carry, us.alias("_us"), first.alias("_first")).withColumns({
        "_bhi": F.floor(F.col("_us") / F.lit(width)),
        "_blo": F.floor(F.col("_first") / F.lit(width))})
    tiers = _tiers(df, value)
    parts = _parts(value, tiers)
    names = [name for name, _, _ in parts]
    right = df.select(*k, us.alias("_rus"), *[v.cast(kind).alias(name)
                                              for name, v, kind in parts]).withColumn(
        "_b", F.floor(F.col("_rus") / F.lit(width)))
    row_keys = [*k, ts, *carry]

    # Buckets wholly inside the frame: one pre-summed row per (series, bucket).
    sums = right.groupBy(*k, "_b").agg(*[F.sum(name).cast(kind).alias(name)
                                         for name, _, kind in parts])
    inner = left.select(*row_keys, F.explode(F.sequence(
        F.col("_blo") + 1, F.greatest(F.col("_bhi") - 1, F.col("_blo") + 1))).alias("_b"),
        "_blo", "_bhi").filter(F.col("_b") < F.col("_bhi"))
    full = join_null_safe(inner, sums, [*k, "_b"]).select(*row_keys, *names)

    # The two boundary buckets, row by row with the range predicate. An
    # explicit partition count keeps AQE from coalescing the small input into
    # a few tasks that would then carry the whole join.
    edge = left.select(*row_keys, "_us", "_first", F.explode(F.array_distinct(F.array(
        F.col("_blo"), F.col("_bhi")))).alias("_b")).repartition(n, *k, "_b")
    cond = [edge[c].eqNullSafe(right[c]) for c in k] + [edge["_b"] == right["_b"],
            right["_rus"] <= edge["_us"], right["_rus"] >= edge["_first"]]
    rows = edge.join(right, cond, "left").select(*[edge[c] for c in row_keys], *names)

    total = _total({"_w0": F.sum("_w0"), **{c: F.coalesce(F.sum(c), F.lit(0))
                                            for c in names[1:]}}, tiers)
    return full.unionByName(rows).groupBy(*row_keys).agg(total.alias(out or f"{value}_sum"))
