"""Streams over streams: rolling frames over panes, and a row beside a later one
(EXT of WIN-4 / AGG-2 and of JON-2 / JON-3)."""

from __future__ import annotations

import decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import (DoubleType, LongType, StructField, StructType, TimestampType)

from tickflow.functions.change import exact, exact_sum, odd
from tickflow.functions.temporal import duration_seconds
from tickflow.operators.bars import last_by_time
from tickflow.operators.names import private
from tickflow.streaming.stream import event_time


def streaming_rolling(ticks: DataFrame, width: str = "5 minutes", span: str = "24 hours",
                      delay: str = "10 minutes", *, keys=("symbol",), ts: str = "ts",
                      price: str = "close", volume: str = "volume", tiebreak: str = "tiebreak",
                      out: str = "volume_24h") -> DataFrame:
    """Per bar, the volume of the bars in (t - span, t], as ``rolling.rolling_join``
    gives it, for every bar that the watermark has passed (append mode).

    Two stateful steps under one watermark: ticks become panes of ``width``
    (combined in each task before the shuffle); a second step keeps, per series,
    the panes of the last ``span`` as a list state and sums frames over them. A
    pane leaves the first step once the watermark has passed it, so panes of a
    series come in order. The state is at most span / width panes a series,
    whatever the rate of ticks, and a timer drops it ``span`` after the last.
    Sums are exact as in ``exact_sum``; null volumes add nothing, and a frame of
    nulls alone is null. Output: keys, timestamp (TIMESTAMP), price, ``out``."""
    k = list(keys)
    taken = [*k, "timestamp", "price", out]
    pane, at, part, odd_sum, n = (private(taken, x) for x in ("_pane", "_at", "_part", "_odd", "_n"))
    t = event_time(ticks, ts).withWatermark(ts, delay)
    panes = t.groupBy(*k, F.window(F.col(ts), width).alias(pane)).agg(
        last_by_time(price, ts, tiebreak).alias("price"), exact_sum(F.col(volume)).alias(n))
    v = F.col(n)
    # The event time carries the watermark on; the step reads the end as a number.
    panes = panes.select(
        *k, F.window_time(F.col(pane)), F.unix_micros(F.col(f"{pane}.end")).alias(at), "price", exact(v).alias(part),
        F.when(odd(v) == 1, v.cast("double")).otherwise(F.lit(0.0)).alias(odd_sum))
    schema = StructType([panes.schema[c] for c in k] + [
        StructField("timestamp", TimestampType()), StructField("price", DoubleType()),
        StructField(out, DoubleType())])
    state = StructType([StructField("us", LongType()), StructField("part", panes.schema[part].dataType),
                        StructField("odd", DoubleType())])
    cols = panes.columns
    span_us = duration_seconds(span) * 1_000_000

    # Defined here so that it is shipped by value: workers need numpy and pandas only.
    class Frames(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getListState("open", state)

        def handleInputRows(self, key, rows, timerValues):
            new = pd.concat(list(rows), ignore_index=True)
            new.columns = cols      # Spark hands computed columns over by place
            new = new.sort_values(at).reset_index(drop=True)
            end = new[at].to_numpy()
            held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
            panes = held + [(int(u), None if pd.isna(p) else p, float(o))
                            for u, p, o in zip(end, new[part], new[odd_sum])]
            any_odd = any(x[2] != 0 for x in panes)
            first, known, total, sums = 0, 0, decimal.Decimal(0), []
            with decimal.localcontext() as exactly:
                exactly.prec = 60
                for i, (u, p, _) in enumerate(panes):
                    if p is not None:
                        total, known = total + p, known + 1
                    while panes[first][0] <= u - span_us:
                        if panes[first][1] is not None:
                            total, known = total - panes[first][1], known - 1
                        first += 1
                    if i >= len(held):
                        rest = sum(x[2] for x in panes[first:i + 1]) if any_odd else 0.0
                        sums.append(None if not known else
                                    float(total) if rest == 0 else float(total) + rest)
            self.open.put(panes[first:])
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((panes[-1][0] + span_us) // 1000 + 1)
            frame = {c: [key[i]] * len(new) for i, c in enumerate(k)}
            frame["timestamp"] = pd.to_datetime(end, unit="us")
            frame["price"] = new["price"]
            frame[out] = pd.array(sums, dtype="Float64")
            yield pd.DataFrame(frame)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.open.clear()
            yield from ()

        def close(self) -> None:
            pass

    return panes.groupBy(*k).transformWithStateInPandas(Frames(), schema, "Append", "EventTime")


def join_later(ticks: DataFrame, later: DataFrame, after: str = "15 minutes", *,
               keys=("symbol",), ts: str = "timestamp", value: str = "price",
               out: str = "later_price", delay: str = "12 minutes") -> DataFrame:
    """Each row of the stream ``ticks`` beside the row of the stream ``later``
    that has the same keys (null is a key) and lies ``after`` behind it, as
    ``out``. The time bound lets Spark drop state: a tick waits at most ``after``
    plus ``delay``, and is then emitted once with a null. Several rows of one key
    and time in ``later`` give one row each. Both ``ts`` are TIMESTAMP."""
    k = list(keys)
    used = [*ticks.columns, *later.columns, out]
    at = private(used, "_at")
    names = [private(used, f"_key{i}") for i in range(len(k))]
    left = ticks.withWatermark(ts, delay)
    right = later.withWatermark(ts, delay).select(
        *[F.col(c).alias(n) for c, n in zip(k, names)], F.col(ts).alias(at),
        F.col(value).alias(out))
    gap = F.expr(f"INTERVAL {after}")
    cond = F.col(at) == F.col(ts) + gap
    for c, n in zip(k, names):
        cond = cond & F.col(c).eqNullSafe(F.col(n))
    # The same as bounds, from which Spark derives how long a row must wait.
    cond = cond & (F.col(at) >= F.col(ts) + gap) & (F.col(at) <= F.col(ts) + gap)
    return left.join(right, cond, "left_outer").select(*ticks.columns, out)
