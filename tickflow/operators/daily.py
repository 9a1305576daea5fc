"""Daily signal from predictions (AGG-3, AGG-4, FLT-5..7, AGG-12).

Input: prediction rows (label 0/1, prob, price, time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.change import clip_below
from tickflow.operators.bars import gap_fill, last_by_time


def daily_signal(preds: DataFrame, *, keys=(), time: str = "time", label: str = "label",
                 prob: str = "prob", price: str = "price", period: str = "1 day",
                 tiebreak: str | None = None) -> DataFrame:
    """AGG-3 + FLT-6: per day the number of buy predictions, the number of
    scored rows, the last price and ``buy_ratio`` = buys / scored (Q21). Only days
    with scored rows appear (the reference drops count-0 days)."""
    k = list(keys)
    g = preds.groupBy(*k, F.window(F.col(time), period).alias("_d")).agg(
        F.sum(F.col(label)).alias("buys"),
        F.count(F.col(prob)).alias("n"),
        last_by_time(price, time, tiebreak).alias("last_price"))
    g = g.filter(F.col("n") != 0)
    return g.select(*k, F.col("_d.start").alias("day"), "buys", "n", "last_price",
                    F.try_divide(F.col("buys"), F.col("n")).cast("double").alias("buy_ratio"))


def daily_signal_filled(preds: DataFrame, *, keys=(), time: str = "time", **kw) -> DataFrame:
    """AGG-4: as ``daily_signal`` but every day between the first and last is
    present; empty days have buys = n = 0 and null price and ratio."""
    k = list(keys)
    d = daily_signal(preds, keys=k, time=time, **kw)
    if not k:
        d = d.withColumn("_all", F.lit(0))
    out = gap_fill(d, "1 day", keys=k or ["_all"], ts="day")
    out = out.fillna({"buys": 0.0, "n": 0}) if not _is_int(d, "buys") else out.fillna(
        {"buys": 0, "n": 0})
    return out.drop("_all") if not k else out


def _is_int(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() in ("integer", "long")


def clip_ratio(signal: DataFrame, threshold: float = 0.5, col: str = "buy_ratio",
               out: str = "buy_signal") -> DataFrame:
    """FLT-7: ratios below the threshold shown as 0."""
    return signal.withColumn(out, clip_below(F.col(col), threshold))


def in_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """FLT-5: inclusive range filter (pushed to the scan)."""
    t = df.schema[col].dataType
    return df.filter(F.col(col).between(F.lit(start).cast(t), F.lit(end).cast(t)))


def time_extent(df: DataFrame, col: str = "time", keys=()) -> DataFrame:
    """AGG-12: first and last time (per key when given)."""
    return df.groupBy(*keys).agg(F.min(col).alias("first_time"), F.max(col).alias("last_time"))
