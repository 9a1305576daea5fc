"""Tumbling-window bars (AGG-1) and gap filling (AGG-4).

Bars are one hash aggregate keyed by (symbol, window): Spark runs a partial
aggregate before the shuffle, so a hot symbol is pre-combined map-side and
the shuffle carries at most one row per (task, symbol, window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tickflow.functions.change import exact_sum
from tickflow.functions.temporal import duration_seconds
from tickflow.session import stage


def _keys(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


# Packing (event time, integer tiebreak) into one decimal(38,0) keeps the
# ordering fixed-width, so Spark can use a hash aggregate; a struct ordering
# forces a sort-based aggregate. micros * 10^20 + (tiebreak + 2^63) orders
# exactly like (micros, tiebreak) for any long tiebreak and any year < 5000.
_SHIFT = "CAST('100000000000000000000' AS DECIMAL(38,0))"
_OFFSET = "CAST('9223372036854775808' AS DECIMAL(20,0))"
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def time_order_key(ts: str, tiebreak: str | None, integral_tiebreak: bool = True) -> Column:
    """Ordering of rows by (ts, tiebreak) as one comparable value."""
    if not tiebreak:
        return F.col(ts)
    if not integral_tiebreak:
        return F.struct(F.col(ts), F.col(tiebreak))
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(38,0)")
    # A null tiebreak comes before every other one.
    tb = F.coalesce(F.col(tiebreak).cast("decimal(20,0)") + F.expr(_OFFSET), F.lit(-1))
    return (micros * F.expr(_SHIFT) + tb).cast("decimal(38,0)")


def last_by_time(value: str, ts: str, tiebreak: str | None,
                 integral_tiebreak: bool = True) -> Column:
    """Q1: deterministic 'last' value: the value of the latest row, ties broken by
    a unique column (replaces ``last()`` after a sort, which depends on the
    order rows reach the aggregate)."""
    return F.max_by(F.col(value), time_order_key(ts, tiebreak, integral_tiebreak))


def bars(ticks: DataFrame, width: str = "5 minutes", *, keys=("symbol",),
         ts: str = "ts", price: str = "close", volume: str = "volume",
         tiebreak: str | None = "tiebreak", volume_name: str = "volume",
         exact: bool = True) -> DataFrame:
    """AGG-1: last price and summed volume per window, stamped with the window
    end (Q2: so the 23:55 bar of 31 Dec belongs to the next year, as in the
    reference). Output: keys, timestamp, price, <volume_name>."""
    k = _keys(keys)
    vol = exact_sum(F.col(volume)) if exact else F.sum(volume)
    integral = bool(tiebreak) and isinstance(ticks.schema[tiebreak].dataType, _INTEGRAL)
    agg = (ticks.groupBy(*k, F.window(F.col(ts), width).alias("_w"))
           .agg(last_by_time(price, ts, tiebreak, integral).alias("price"),
                vol.alias(volume_name)))
    return agg.select(*k, F.col("_w.end").alias("timestamp", metadata=bar_metadata(width, k)),
                      "price", volume_name)


# Column metadata carried by bar timestamps: the bar width in seconds. One bar
# per (series, width slot) means a time partition of P seconds holds at most
# P / width rows per series, a bound later windows can rely on without a job.
BAR_WIDTH_KEY = "tickflow.bar_width_seconds"
BAR_SERIES_KEY = "tickflow.bar_series"      # the keys that make a series of the bars


def bar_metadata(width: str, keys=()) -> dict:
    return {BAR_WIDTH_KEY: duration_seconds(width), BAR_SERIES_KEY: list(keys)}


def bar_width_of(df: DataFrame, ts: str, keys=None) -> int | None:
    """Bar width recorded on ``ts`` by ``bars``; None for other input, and when
    ``keys`` lack one of the bars' keys, so that a slot may hold several rows."""
    meta = df.schema[ts].metadata if ts in df.columns else {}
    if keys is not None and not set(meta.get(BAR_SERIES_KEY, ())) <= set(_keys(keys)):
        return None
    return meta.get(BAR_WIDTH_KEY)


def slot_grid(bars_df: DataFrame, width: str, *, keys=("symbol",),
              ts: str = "timestamp", chunk: str = "1 day") -> DataFrame:
    """Every slot between each series' first and last bar.

    Built in two levels so no row holds an unbounded array: the span is cut
    into chunks (days), the chunk rows are spread over the cluster, then each
    chunk expands into at most chunk/width slots."""
    k = _keys(keys)
    w = duration_seconds(width)
    c = max(duration_seconds(chunk) // w, 1) * w
    span = bars_df.groupBy(*k).agg(
        F.unix_seconds(F.min(ts).cast("timestamp")).alias("_lo"),
        F.unix_seconds(F.max(ts).cast("timestamp")).alias("_hi"))
    chunks = span.select(*k, "_lo", "_hi", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_hi") - F.col("_lo")) / c).cast("long")
    )).alias("_c"))
    n = int(bars_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(n, *k, "_c")
    slots = chunks.select(*k, F.explode(F.sequence(
        F.col("_lo") + F.col("_c") * c,
        F.least(F.col("_hi"), F.col("_lo") + F.col("_c") * c + (c - w)),
        F.lit(w).cast("long"))).alias("_s"))
    return slots.select(*k, F.timestamp_seconds("_s").cast(
        bars_df.schema[ts].dataType).alias(ts, metadata=bar_metadata(width, k)))


def gap_fill(bars_df: DataFrame, width: str, *, keys=("symbol",),
             ts: str = "timestamp", fill: dict | None = None,
             stage_input: bool = True) -> DataFrame:
    """AGG-4: keep empty slots as rows (null measures, or ``fill`` values).
    The bars are read twice (series extents, join), so they are staged."""
    k = _keys(keys)
    if stage_input:
        bars_df = stage(bars_df)
    from tickflow.operators.joins import join_null_safe
    out = join_null_safe(slot_grid(bars_df, width, keys=k, ts=ts), bars_df, [*k, ts], "left")
    return out.fillna(fill) if fill else out
