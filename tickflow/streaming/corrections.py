"""Row lags on a stream whose late rows correct later ones (EXT of WIN-1).

``transformWithStateInPandas`` keeps, per (series, partition of time), the rows
seen so far as a list state. A row that comes late is put in its place, and the
rows whose lags it moves are emitted again; an upsert by (series, time) then ends
in the batch answer. An event-time timer drops a list once the watermark has
passed the end of its partition, so at most partition / width rows a live series
are kept. Rows older than the watermark are dropped by Spark: ``delay`` is the
lateness that is still corrected.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import (DoubleType, LongType, StructField, StructType)

from tickflow.functions.temporal import duration_label, duration_seconds
from tickflow.operators.names import private


def corrected_lag_features(bars: DataFrame, horizons: Sequence[str], width: str = "5 minutes", *,
                           keys=("symbol",), ts: str = "timestamp", price: str = "price",
                           partition: str = "1 week", delay: str = "1 hour") -> DataFrame:
    """``bars``: a stream with ``ts`` as TIMESTAMP. Output, to be upserted by
    ``keys`` and ``ts``: keys, ts, price and ``percent_change_<h>`` per horizon
    (rows mode). A time sent again replaces its price; of equal times in one
    batch the largest price counts. Rows without a time are left out; a null
    price is a row, whose changes are null."""
    k = list(keys)
    wsec = duration_seconds(width)
    specs = [(f"percent_change_{duration_label(duration_seconds(h))}",
              duration_seconds(h) // wsec) for h in horizons]
    reach = max(n for _, n in specs)
    part_ms = duration_seconds(partition) * 1000
    part = private(bars.columns, "_part")
    d = (bars.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
         .select(*k, ts, F.col(price).cast("double").alias(price),
                 F.window(F.col(ts), partition).start.alias(part)))
    out = StructType([d.schema[c] for c in k] + [StructField(ts, d.schema[ts].dataType),
                     StructField(price, DoubleType())]
                     + [StructField(n, DoubleType()) for n, _ in specs])
    state = StructType([StructField("us", LongType()), StructField("price", DoubleType())])

    # Defined here so that it is shipped by value: workers need numpy and pandas only.
    class Lags(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.seen = handle.getListState("seen", state)

        def handleInputRows(self, key, rows, timerValues):
            new = {}
            for b in rows:
                us = b[ts].astype("datetime64[us]").astype("int64").to_numpy()
                p = b[price].to_numpy(dtype=float)
                for u, v in zip(us.tolist(), p.tolist()):
                    if u not in new or not (v <= new[u]):
                        if not (u in new and np.isnan(v)):
                            new[u] = v
            if not new:
                return
            known = self.seen.exists()
            old = [(r[0], r[1]) for r in self.seen.get()] if known else []
            held = {u: (np.nan if p is None else p) for u, p in old}
            last = old[-1][0] if old else None
            changed = sorted(u for u in new
                             if u not in held or not (new[u] == held[u] or
                                                      (np.isnan(new[u]) and np.isnan(held[u]))))
            if not changed:
                return
            fresh = [(u, None if np.isnan(new[u]) else new[u]) for u in changed]
            if last is None or changed[0] > last:
                self.seen.appendList(fresh)
            else:
                self.seen.put(sorted({**dict(old), **dict(fresh)}.items()))
            if not known:
                start_ms = int(pd.Timestamp(key[-1]).value // 1_000_000)
                self.handle.registerTimer(start_ms + part_ms)
            held.update({u: new[u] for u in changed})
            at = np.array(sorted(held), dtype=np.int64)
            p = np.array([held[u] for u in at.tolist()], dtype=float)
            touched = np.zeros(len(at) + 1, dtype=int)
            where = np.searchsorted(at, np.array(changed, dtype=np.int64))
            np.add.at(touched, where, 1)
            np.add.at(touched, np.minimum(where + reach + 1, len(at)), -1)
            rows_out = np.flatnonzero(np.cumsum(touched[:-1]) > 0)
            # pandas holds the times of a frame as UTC wall time without a zone.
            frame = {c: [key[i]] * len(rows_out) for i, c in enumerate(k)}
            frame[ts] = pd.to_datetime(at[rows_out], unit="us")
            frame[price] = pd.array(p[rows_out], dtype="Float64")
            for name, lag in specs:
                r = np.full(len(at), np.nan)
                if len(at) > lag:
                    prev = p[:-lag]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        r[lag:] = np.where(prev == 0, np.nan, (p[lag:] - prev) / prev)
                frame[name] = pd.array(r[rows_out], dtype="Float64")
            yield pd.DataFrame(frame)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.seen.clear()
            yield from ()

        def close(self) -> None:
            pass

    return d.groupBy(*k, part).transformWithStateInPandas(
        Lags(), out, "Update", "EventTime")
