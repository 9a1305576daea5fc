"""Rolling volume, moving average, daily signal and keyed-join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.change import direction
from tickflow.operators import bars as B
from tickflow.operators import daily as D
from tickflow.operators import lags as G
from tickflow.operators import rolling as R
from tickflow.operators.columns import append, first_rows
from tickflow.operators.joins import keyed_outer_join
from tickflow.plans import oracle_sql as O
from tickflow.plans.registry import query
from tickflow.plans.series import REF, _bars
from tickflow.session import stage
from tickflow.sources.events import read_ticks
from tickflow.sources.tables import read_table

_B5 = O.bars("5 minutes")
_DEC = "CAST(SUM(CAST({c} AS DECIMAL(28,8))) {o} AS DOUBLE)"


# --------------------------------------------------------------------------- rolling
@query("rolling_24h_join", ("JON-1", "AGG-2", "SCL-7"), oracle=f"""
WITH b AS ({_B5})
SELECT a.symbol, a.timestamp, a.price, {_DEC.format(c='c.volume', o='')} AS volume_24h
FROM b a LEFT JOIN b c ON c.symbol = a.symbol AND c.timestamp <= a.timestamp
     AND c.timestamp > a.timestamp - INTERVAL '24 hours'
GROUP BY 1, 2, 3""")
def rolling_24h_join(spark, sf_dir):
    """Per 5-minute bar, volume of the bars in (t - 24h, t] via a bucketed
    range self-join and a group-by (never a nested-loop join)."""
    return R.rolling_join(_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h")


_RANGE_SQL = f"""
SELECT symbol, timestamp, price, volume,
       {_DEC.format(c='volume', o='OVER (PARTITION BY symbol ORDER BY timestamp RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)')} AS volume_24h
FROM ({_B5}) b"""


@query("rolling_24h_range", ("WIN-4",), oracle=_RANGE_SQL)
def rolling_24h_range(spark, sf_dir):
    """Per bar, volume over the closed frame [t - 24h, t]: the bar width
    bounds each (series, day) group, so time-bucket halo partitions and the
    difference of two running RANGE-frame totals are used."""
    return R.rolling_sum(_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h")


@query("rolling_24h_range_sliced", ("WIN-4",), oracle=_RANGE_SQL)
def rolling_24h_range_sliced(spark, sf_dir):
    """rolling_24h_range through the skew-proof plan: per-(series, time)
    sums, running totals over quantile time slices with per-slice offsets,
    and an as-of lookup of the total before each frame's lower edge."""
    return R.rolling_sum(_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h",
                         method="slices")


# Volumes with eight decimals: every plan must keep them all.
_FINE_BARS = f"""SELECT symbol, time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01')
         + INTERVAL '5 minutes' AS timestamp, arg_max(close, (ts, tiebreak)) AS price,
       CAST(SUM(CAST(round(volume + 0.00000013, 8) AS DECIMAL(38,10))) AS DOUBLE) AS volume
FROM ({O.ticks()}) t GROUP BY 1, 2"""


def _fine_sql(first: str) -> str:
    return f"""
WITH b AS ({_FINE_BARS})
SELECT a.symbol, a.timestamp, a.price,
       CAST(SUM(CAST(c.volume AS DECIMAL(38,10))) AS DOUBLE) AS volume_24h
FROM b a JOIN b c ON c.symbol = a.symbol AND c.timestamp <= a.timestamp
     AND c.timestamp {first} a.timestamp - INTERVAL '24 hours' GROUP BY 1, 2, 3"""


def _fine_bars(spark, sf_dir):
    ticks = read_ticks(spark, sf_dir).withColumn(
        "volume", F.round(F.col("volume") + F.lit(0.00000013), 8))
    return B.bars(ticks, "5 minutes")


@query("rolling_24h_fine", ("WIN-4",), oracle=_fine_sql(">="))
def rolling_24h_fine(spark, sf_dir):
    """Rolling volume of eight-decimal volumes through the halo plan."""
    r = R.rolling_sum(_fine_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h")
    return r.drop("volume")


@query("rolling_24h_fine_sliced", ("WIN-4",), oracle=_fine_sql(">="))
def rolling_24h_fine_sliced(spark, sf_dir):
    """rolling_24h_fine through the slices plan."""
    r = R.rolling_sum(_fine_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h",
                      method="slices")
    return r.drop("volume")


@query("rolling_24h_fine_join", ("JON-1", "AGG-2"), oracle=_fine_sql(">"))
def rolling_24h_fine_join(spark, sf_dir):
    """Rolling volume of eight-decimal volumes through the range join."""
    return R.rolling_join(_fine_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h")


@query("volume_change_rolling", ("WIN-5", "SCL-8", "SCL-14", "Q11"), oracle=f"""
SELECT symbol, timestamp, price, volume_24h,
       CAST(((volume_24h - lag(volume_24h) OVER w) / NULLIF(lag(volume_24h) OVER w, 0)) * 100 AS DOUBLE)
         AS volume_24h_change_24h
FROM ({_RANGE_SQL}) r WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)""")
def volume_change_rolling(spark, sf_dir):
    """Change of the rolling 24h volume against the previous bar, in percent,
    over each whole series (plain per-series window when every series is
    measured to fit one task, else dense index + chunk halo)."""
    r = R.rolling_sum(_bars(spark, sf_dir), "volume", "24 hours", out="volume_24h")
    c = G.lag_change(r, "volume_24h", rows=1, partition=None, out="volume_24h_change_24h")
    return c.select("symbol", "timestamp", "price", "volume_24h", "volume_24h_change_24h")


@query("volume_change_bar", ("WIN-6", "SCL-11"), oracle=f"""
SELECT *, round(((volume - lag(volume) OVER w) / NULLIF(lag(volume) OVER w, 0)) * 100, 2)
         AS volume_change_5m
FROM ({_B5}) b WINDOW w AS (PARTITION BY symbol ORDER BY timestamp)""")
def volume_change_bar(spark, sf_dir):
    """Bar volume change against the previous bar, percent, 2 decimals."""
    return G.lag_change(_bars(spark, sf_dir), "volume", rows=1, partition=None,
                        out="volume_change_5m", round_to=2)


@query("moving_avg_20", ("WIN-7",), oracle=f"""
SELECT *, CASE WHEN count(price) OVER w = 20
          THEN {_DEC.format(c='price', o='OVER w')} / 20.0 END AS ma_20
FROM ({_B5}) b
WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def moving_avg_20(spark, sf_dir):
    """20-bar moving average of price per series, null for the first 19."""
    return G.moving_average(_bars(spark, sf_dir), "price", 20, out="ma_20")


@query("moving_avg_20_halo", ("WIN-7", "WIN-8"), oracle=f"""
SELECT *, CASE WHEN count(price) OVER w = 20
          THEN {_DEC.format(c='price', o='OVER w')} / 20.0 END AS ma_20
FROM ({_B5}) b
WINDOW w AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def moving_avg_20_halo(spark, sf_dir):
    """moving_avg_20 always through the large-series plan: dense index by
    quantile slices, chunks of 1024 bars each extended by the 19 bars before
    it, one window per chunk."""
    return G.moving_average(_bars(spark, sf_dir), "price", 20, out="ma_20", chunk_rows=1024,
                            max_group_rows=None)


# --------------------------------------------------------------------------- predictions
def rule_predictions(spark, sf_dir, bars=None):
    """Prediction-shaped rows (F5 + symbol) from a transparent momentum rule
    over the 5-minute feature table: predict 'buy' when the last 15-minute
    change is positive; prob = 0.5 + change, clipped to [0, 1]."""
    b = bars if bars is not None else _bars(spark, sf_dir)
    f = G.drop_incomplete(G.pct_change_features(b, REF, "5 minutes"))
    pc = F.col("percent_change_15m")
    return f.select("symbol", F.col("timestamp").alias("time"), "price",
                    direction(pc).cast("double").alias("label"),
                    F.least(F.greatest(F.lit(0.5) + pc, F.lit(0.0)), F.lit(1.0)).alias("prob"))


_PREDS_SQL = f"""
SELECT symbol, timestamp AS time, price,
       CASE WHEN percent_change_15m > 0 THEN 1.0 ELSE 0.0 END AS label,
       least(greatest(0.5 + percent_change_15m, 0.0), 1.0) AS prob
FROM ({O.week_lags(_B5, REF, '5 minutes')}) x
WHERE {O.not_null([n for n, _, _ in O.lag_names(REF, '5 minutes')])}"""

_DAILY_SQL = f"""
SELECT symbol, time_bucket(INTERVAL '1 day', time) AS day, SUM(label) AS buys,
       COUNT(prob) AS n, arg_max(price, time) AS last_price,
       SUM(label) / COUNT(prob) AS buy_ratio
FROM ({_PREDS_SQL}) p GROUP BY 1, 2 HAVING COUNT(prob) <> 0"""


@query("daily_signal", ("AGG-3", "FLT-6", "Q21"), oracle=_DAILY_SQL)
def daily_signal(spark, sf_dir):
    """Per symbol and day: buy predictions, scored rows, last price, ratio."""
    return D.daily_signal(rule_predictions(spark, sf_dir), keys=["symbol"])


@query("daily_signal_filled", ("AGG-4", "AGG-3"), oracle=f"""
WITH d AS ({_DAILY_SQL}),
r AS (SELECT symbol, min(day) AS lo, max(day) AS hi FROM d GROUP BY 1),
g AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '1 day')) AS day FROM r)
SELECT g.symbol, g.day, coalesce(d.buys, 0.0) AS buys, coalesce(d.n, 0) AS n,
       d.last_price, d.buy_ratio
FROM g LEFT JOIN d ON d.symbol = g.symbol AND d.day = g.day""")
def daily_signal_filled(spark, sf_dir):
    """Daily signal with empty days kept (zero counts, null ratio)."""
    return D.daily_signal_filled(rule_predictions(spark, sf_dir), keys=["symbol"])


@query("clip_threshold", ("FLT-7",), oracle=f"""
SELECT *, CASE WHEN buy_ratio < 0.5 THEN 0.0 ELSE buy_ratio END AS buy_signal
FROM ({_DAILY_SQL}) d""")
def clip_threshold(spark, sf_dir):
    """Daily buy ratio with values under 0.5 shown as 0."""
    return D.clip_ratio(D.daily_signal(rule_predictions(spark, sf_dir), keys=["symbol"]))


@query("keyed_outer_join", ("JON-2", "JON-3"), oracle=f"""
SELECT coalesce(b.symbol, p.symbol) AS symbol, coalesce(b.timestamp, p.time) AS timestamp,
       b.price, p.label AS prediction, p.prob
FROM ({_B5}) b FULL OUTER JOIN ({_PREDS_SQL}) p ON b.symbol = p.symbol AND b.timestamp = p.time""")
def keyed_outer_join_q(spark, sf_dir):
    """Predictions aligned with the original bars by (symbol, timestamp). The
    bars feed both sides, so they are staged once (checkpoint)."""
    bars = stage(_bars(spark, sf_dir))
    preds = rule_predictions(spark, sf_dir, bars).select(
        "symbol", F.col("time").alias("timestamp"), F.col("label").alias("prediction"), "prob")
    return keyed_outer_join(bars.select("symbol", "timestamp", "price"), preds,
                            ["symbol", "timestamp"])


# --------------------------------------------------------------------------- events
_EV = ["event_id", "ts", "event_type", "value"]


@query("date_range", ("FLT-5",), oracle="""
SELECT event_id, ts, event_type, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-06 01:00:00' AND TIMESTAMP '2024-01-09 09:15:00'""")
def date_range(spark, sf_dir):
    """Events in an inclusive time range (the filter reaches the scan)."""
    ev = read_table(spark, sf_dir, "events", _EV)
    return D.in_range(ev, "ts", "2024-01-06 01:00:00", "2024-01-09 09:15:00")


@query("time_extent", ("AGG-12",), oracle="""
SELECT event_type, min(ts) AS first_time, max(ts) AS last_time FROM events GROUP BY 1""")
def time_extent(spark, sf_dir):
    """First and last event time per event type."""
    return D.time_extent(read_table(spark, sf_dir, "events", ["event_type", "ts"]),
                         "ts", keys=["event_type"])


@query("top_n_by_time", ("SRT-1", "SRT-3"), oracle="""
SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 100""")
def top_n_by_time(spark, sf_dir):
    """The 100 earliest events (a top-k report: the limit is the feature)."""
    return first_rows(read_table(spark, sf_dir, "events", _EV), ["ts", "event_id"], 100)


@query("append_history", ("SET-2",), oracle="""
SELECT event_id, ts, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
UNION ALL
SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'""")
def append_history(spark, sf_dir):
    """Events after a cut-off appended to the history before it."""
    ev = read_table(spark, sf_dir, "events", _EV)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return append(ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut))
