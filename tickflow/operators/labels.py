"""Forward-looking direction label (WIN-3, SCL-12, Q5, Q28) and the feature
table that feeds training (WIN-1 -> FLT-3 -> WIN-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.change import direction, pct_change
from tickflow.functions.temporal import duration_label, duration_seconds, epoch_seconds_of
from tickflow.operators.lags import (PART_COL, REFERENCE_HORIZONS, drop_incomplete,
                                     pct_change_features, row_shifts)
from tickflow.operators.names import any_names


@any_names(handed_on=(PART_COL,))
def direction_label(df: DataFrame, horizon: str = "15 minutes", width: str = "5 minutes", *,
                    keys=("symbol",), ts: str = "timestamp", price: str = "price",
                    partition: str | None = "1 week", unlabeled: str = "zero",
                    target: str = "target", keep_partition: bool = False,
                    chunk_rows: int = 100_000) -> DataFrame:
    """Adds ``price_plus_<h>`` (price ``h`` later, counted in rows inside the
    partition), ``price_change_<h>`` and ``target`` = 1 if it rose.

    ``unlabeled="zero"`` keeps the reference behaviour: rows with no future
    price (the last rows of each week) get target 0. ``"drop"`` removes them.
    """
    rows = duration_seconds(horizon) // duration_seconds(width)
    lbl = duration_label(duration_seconds(horizon))
    plus, chg = f"price_plus_{lbl}", f"price_change_{lbl}"
    d = row_shifts(df, {plus: (price, -rows)}, keys=keys, ts=ts, partition=partition,
                   keep_partition=keep_partition, chunk_rows=chunk_rows)
    if unlabeled == "drop":
        d = d.filter(F.col(plus).isNotNull())
    elif unlabeled != "zero":
        raise ValueError("unlabeled must be 'zero' or 'drop'")
    d = d.withColumn(chg, pct_change(F.col(plus), F.col(price)))
    return d.withColumn(target, direction(F.col(chg)))


def past_direction(df: DataFrame, change_col: str = "percent_change_15m",
                   out: str = "past_direction", drop_source: bool = False) -> DataFrame:
    """Q28: direction of the *current* change (the notebook's label), kept
    under its own name so it is never mistaken for the forward label."""
    d = df.withColumn(out, direction(F.col(change_col)))
    return d.drop(change_col) if drop_source else d


@any_names
def feature_table(bars: DataFrame, width: str = "5 minutes",
                  horizons: Sequence[str | int] = tuple(REFERENCE_HORIZONS), *,
                  label_horizon: str = "15 minutes", keys=("symbol",), ts: str = "timestamp",
                  price: str = "price", partition: str | None = "1 week", drop: bool = True,
                  unlabeled: str = "zero") -> DataFrame:
    """Bars -> lagged changes -> null drop -> forward label. Q6: ``drop=False``
    keeps incomplete rows; Q7: the table is always returned.

    With ``partition`` set, the partition key is computed once and both
    windows share one exchange and one sort."""
    f = pct_change_features(bars, horizons, width, keys=keys, ts=ts, price=price,
                            partition=partition, keep_partition=True)
    if drop:
        f = drop_incomplete(f)
    out = direction_label(f, label_horizon, width, keys=keys, ts=ts, price=price,
                          partition=partition, unlabeled=unlabeled, keep_partition=True)
    return out.drop(PART_COL) if PART_COL in out.columns else out


def feature_table_between(ticks: DataFrame, start: str, end: str, width: str = "5 minutes",
                          horizons: Sequence[str | int] = tuple(REFERENCE_HORIZONS), *,
                          label_horizon: str = "15 minutes", keys=("symbol",),
                          ts: str = "ts", partition: str = "1 week", **bar_kw) -> DataFrame:
    """Feature table rows with bar time in [start, end), computed from only
    the ticks that can influence them (FLT-1 with pushdown).

    A time filter on the feature table stays above its windows, so the scan
    would read all history. Lags and the forward label never cross a
    ``partition`` boundary, so it is exact to keep only the ticks whose bars
    fall in the partitions overlapping [start, end) (bar = window end, hence
    the one-width shift), compute, then cut to [start, end). The tick filter
    is a plain range on the event time and reaches the parquet scan."""
    from tickflow.operators.bars import bars as make_bars
    p = duration_seconds(partition)
    w = duration_seconds(width)
    t0 = int(epoch_seconds_of(start))
    t1 = int(epoch_seconds_of(end))
    lo, hi = (t0 // p) * p, -(-t1 // p) * p
    ttype = ticks.schema[ts].dataType
    bound = lambda sec: F.timestamp_seconds(F.lit(sec)).cast(ttype)
    sel = ticks.filter((F.col(ts) >= bound(lo - w)) & (F.col(ts) < bound(hi - w)))
    f = feature_table(make_bars(sel, width, keys=keys, ts=ts, **bar_kw), width, horizons,
                      label_horizon=label_horizon, keys=keys, partition=partition)
    btype = f.schema["timestamp"].dataType
    return f.filter((F.col("timestamp") >= F.lit(start).cast(btype))
                    & (F.col("timestamp") < F.lit(end).cast(btype)))

