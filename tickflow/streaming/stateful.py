"""Row lags on a stream (EXT: WIN-1 over Structured Streaming).

Spark rejects ``lag`` on streaming frames. Here Spark groups each
micro-batch by (symbol, week) and keeps, per group, the last ``max(lags)``
(timestamp, price) pairs as state; a small pandas step lags the batch's rows
against that state. A group's state is dropped by an event-time timeout once
the watermark passes the end of its week, so state size is bounded by
(live groups x max lag).

Rows older than the newest row already seen for their group cannot be placed
without rewriting emitted rows; they are emitted with ``late = true`` and
null changes, and they do not enter the state.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StructField,
                               StructType)

from tickflow.functions.temporal import duration_label, duration_seconds

STATE = StructType([StructField("ts", ArrayType(LongType())),
                    StructField("price", ArrayType(DoubleType()))])


def stream_lag_features(bars: DataFrame, horizons: Sequence[str], width: str = "5 minutes", *,
                        keys=("symbol",), ts: str = "timestamp", price: str = "price",
                        partition: str = "1 week", delay: str = "1 hour") -> DataFrame:
    """Streaming counterpart of ``lags.pct_change_features`` (rows mode).

    ``bars`` is a streaming frame with ``ts`` as TIMESTAMP. Output: the input
    columns, ``percent_change_<h>`` per horizon and ``late``."""
    k = list(keys)
    wsec = duration_seconds(width)
    specs = [(f"percent_change_{duration_label(duration_seconds(h))}",
              duration_seconds(h) // wsec) for h in horizons]
    keep = max(n for _, n in specs)
    part_ms = duration_seconds(partition) * 1000
    d = (bars.withWatermark(ts, delay)
         .withColumn("_part", F.window(F.col(ts), partition).start))
    in_fields = [f for f in d.schema.fields if f.name != "_part"]
    out_schema = StructType(in_fields + [StructField(n, DoubleType()) for n, _ in specs]
                            + [StructField("late", BooleanType())])
    cols = [f.name for f in in_fields]
    names = [n for n, _ in specs]

    # Everything the step uses is defined here, so the function is shipped to
    # the Python workers by value: they need numpy and pandas, not this package.
    def changes(price: np.ndarray, lag: int) -> np.ndarray:
        """(p - p[-lag]) / p[-lag]; NaN where there is no earlier row or it is 0."""
        out = np.full(len(price), np.nan)
        if len(price) > lag:
            prev, cur = price[:-lag], price[lag:]
            with np.errstate(divide="ignore", invalid="ignore"):
                r = (cur - prev) / prev
            r[prev == 0] = np.nan
            out[lag:] = r
        return out

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Arrow batching in the worker concatenates frames whose feature
        # columns may be all null (first rows of a week); pandas warns.
        warnings.filterwarnings("ignore", category=FutureWarning)
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(batches), ignore_index=True)
        if new.empty:
            return
        new = new.sort_values(ts, kind="mergesort").reset_index(drop=True)
        us = new[ts].astype("datetime64[us]").astype("int64").to_numpy()
        hist_ts, hist_p = (list(state.get[0]), list(state.get[1])) if state.exists else ([], [])
        late = us <= hist_ts[-1] if hist_ts else np.zeros(len(new), dtype=bool)
        ok = new[~late]
        comb_p = np.concatenate([np.asarray(hist_p, dtype=float),
                                 ok[price].to_numpy(dtype=float)])
        comb_ts = np.concatenate([np.asarray(hist_ts, dtype=np.int64), us[~late]])
        start = len(hist_p)
        out_ok = ok[cols].copy()
        for n, lag in specs:
            out_ok[n] = pd.array(changes(comb_p, lag)[start:], dtype="Float64")
        out_ok["late"] = False
        out_late = new[late][cols].copy()
        for n in names:
            out_late[n] = pd.array([None] * len(out_late), dtype="Float64")
        out_late["late"] = True
        state.update((comb_ts[-keep:].tolist(), comb_p[-keep:].tolist()))
        week_start_ms = int(pd.Timestamp(key[-1]).value // 1_000_000)
        state.setTimeoutTimestamp(week_start_ms + part_ms)
        for part in (out_ok, out_late):
            if len(part):
                yield part

    return d.groupBy(*k, "_part").applyInPandasWithState(
        step, out_schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
