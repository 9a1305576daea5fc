"""Bar, lag, label and index queries over the events-as-ticks stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.change import prior_from_change
from tickflow.operators import bars as B
from tickflow.operators import labels as L
from tickflow.operators import lags as G
from tickflow.operators.index import dense_index
from tickflow.plans import oracle_sql as O
from tickflow.plans.registry import query
from tickflow.sources.events import read_ticks
from tickflow.sources.tables import read_table

REF = G.REFERENCE_HORIZONS
HOURLY = ["1 hour", "3 hours", "6 hours", "12 hours", "24 hours"]


def _bars(spark, sf_dir, width="5 minutes", single=False):
    return B.bars(read_ticks(spark, sf_dir, single_series=single), width)


# --------------------------------------------------------------------------- bars
@query("bars_5m", ("AGG-1", "SCL-5", "SCL-6", "PRJ-8"), oracle=O.bars("5 minutes", True))
def bars_5m(spark, sf_dir):
    """All events as one series -> 5-minute bars (last close, summed volume)."""
    return _bars(spark, sf_dir, "5 minutes", single=True)


@query("bars_5m_by_symbol", ("AGG-1", "SCL-5", "SCL-6"), oracle=O.bars("5 minutes"))
def bars_5m_by_symbol(spark, sf_dir):
    """5-minute bars per symbol."""
    return _bars(spark, sf_dir, "5 minutes")


@query("bars_1h_gap_filled", ("AGG-1", "AGG-4"), oracle=f"""
WITH b AS ({O.bars('1 hour')}),
r AS (SELECT symbol, min(timestamp) AS lo, max(timestamp) AS hi FROM b GROUP BY 1),
g AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS timestamp FROM r)
SELECT g.symbol, g.timestamp, b.price, b.volume
FROM g LEFT JOIN b ON b.symbol = g.symbol AND b.timestamp = g.timestamp""")
def bars_1h_gap_filled(spark, sf_dir):
    """Hourly bars per symbol with every empty hour kept as a row."""
    return B.gap_fill(_bars(spark, sf_dir, "1 hour"), "1 hour")


@query("bars_1h_whole_dollar", ("AGG-1", "SCL-17"), oracle=f"""
SELECT symbol, timestamp, round(price, 0) AS price_whole, volume FROM ({O.bars('1 hour')}) b""")
def bars_1h_whole_dollar(spark, sf_dir):
    """Hourly bars per symbol with the last price rounded to a whole unit."""
    from tickflow.functions.change import whole_units
    b = _bars(spark, sf_dir, "1 hour")
    return b.select("symbol", "timestamp", whole_units(F.col("price")).alias("price_whole"),
                    "volume")


# --------------------------------------------------------------------------- lags
_WEEK_LAGS = O.week_lags(O.bars("5 minutes"), REF, "5 minutes")
_REF_NAMES = [n for n, _, _ in O.lag_names(REF, "5 minutes")]


@query("pct_change_week", ("WIN-1", "SCL-9"),
       oracle=f"SELECT * EXCLUDE (wk) FROM ({_WEEK_LAGS}) x")
def pct_change_week(spark, sf_dir):
    """Six lagged fractional changes inside (symbol, week) partitions."""
    return G.pct_change_features(_bars(spark, sf_dir), REF, "5 minutes")


@query("pct_change_week_dropna", ("WIN-1", "FLT-3"),
       oracle=f"SELECT * EXCLUDE (wk) FROM ({_WEEK_LAGS}) x WHERE {O.not_null(_REF_NAMES)}")
def pct_change_week_dropna(spark, sf_dir):
    """Week-partitioned changes with incomplete rows dropped."""
    return G.drop_incomplete(G.pct_change_features(_bars(spark, sf_dir), REF, "5 minutes"))


def _time_mode_oracle():
    b = O.bars("5 minutes")
    joins, cols = [], []
    for i, (name, _, sec) in enumerate(O.lag_names(REF, "5 minutes")):
        joins.append(f"LEFT JOIN b p{i} ON p{i}.symbol = b.symbol AND "
                     f"p{i}.timestamp = b.timestamp - INTERVAL '{sec} seconds'")
        cols.append(f"{O.change('b.price', f'p{i}.price')} AS {name}")
    return (f"WITH b AS ({b}) SELECT b.symbol, b.timestamp, b.price, b.volume, "
            + ", ".join(cols) + " FROM b " + " ".join(joins))


@query("pct_change_time_mode", ("WIN-1", "Q4"), oracle=_time_mode_oracle())
def pct_change_time_mode(spark, sf_dir):
    """Changes against the bar exactly h earlier in time (null if missing)."""
    return G.pct_change_features(_bars(spark, sf_dir), REF, "5 minutes", mode="time")


def _global_oracle():
    cols = ",\n ".join(
        f"round({O.change('price', f'lag(price, {k}) OVER w')} * 100, 2) AS {name}"
        for name, k, _ in O.lag_names(G.GLOBAL_HORIZONS, "5 minutes"))
    return (f"SELECT *, {cols} FROM ({O.bars('5 minutes', True)}) b "
            f"WINDOW w AS (ORDER BY timestamp)")


@query("pct_change_global", ("WIN-2", "WIN-8", "SCL-8", "SCL-11"), oracle=_global_oracle())
def pct_change_global(spark, sf_dir):
    """One series, lags of 1 bar up to one year, percent units rounded to 2
    places, over the whole series (no week partition). A series measured to
    fit one task gets a plain per-series window; a larger one goes through
    the dense index and chunk-with-halo windows."""
    return G.pct_change_features(_bars(spark, sf_dir, single=True), G.GLOBAL_HORIZONS,
                                 "5 minutes", partition=None, scale=100.0, round_to=2,
                                 chunk_rows=2048)


@query("pct_change_global_halo", ("WIN-2", "WIN-8"), oracle=_global_oracle())
def pct_change_global_halo(spark, sf_dir):
    """As pct_change_global, always through the large-series plan: dense
    index by quantile slices, then chunks extended by a halo as long as the
    longest lag, one window per chunk. A chunk is never shorter than the
    longest lag, so with the one-year lag each chunk spans at least 105,120
    bars (one chunk at the test scales; multi-chunk halos are unit-tested)."""
    return G.pct_change_features(_bars(spark, sf_dir, single=True), G.GLOBAL_HORIZONS,
                                 "5 minutes", partition=None, scale=100.0, round_to=2,
                                 chunk_rows=2048, max_group_rows=None)


@query("pct_inverse", ("SCL-10", "WIN-1"), oracle=f"""
SELECT symbol, timestamp, price, percent_change_15m,
       price / NULLIF(1 + percent_change_15m, 0) AS prior_price_15m,
       lag(price, 3) OVER (PARTITION BY symbol, wk ORDER BY timestamp) AS lag_price_15m
FROM ({O.week_lags(O.bars('5 minutes'), ['15 minutes'], '5 minutes')}) x""")
def pct_inverse(spark, sf_dir):
    """Recover the earlier price from the change (invariant check column
    beside the true lagged price)."""
    f = G.pct_change_features(_bars(spark, sf_dir), ["15 minutes"], "5 minutes",
                              keep_partition=True)
    f = G.row_shifts(f, {"lag_price_15m": ("price", 3)}, keep_partition=False)
    return f.select("symbol", "timestamp", "price", "percent_change_15m",
                    prior_from_change(F.col("price"), F.col("percent_change_15m"))
                    .alias("prior_price_15m"), "lag_price_15m")


# --------------------------------------------------------------------------- labels
def _label_oracle(width, horizons, label_rows, label_name, drop_tail=False, extra=""):
    names = [n for n, _, _ in O.lag_names(horizons, width)]
    lagged = O.week_lags(O.bars(width), horizons, width)
    plus, chg = f"price_plus_{label_name}", f"price_change_{label_name}"
    tail = f"WHERE {plus} IS NOT NULL" if drop_tail else ""
    return f"""
WITH f AS (SELECT * FROM ({lagged}) x WHERE {O.not_null(['price', 'volume'] + names)}),
l AS (SELECT *, lead(price, {label_rows}) OVER (PARTITION BY symbol, wk ORDER BY timestamp) AS {plus}
      FROM f)
SELECT * EXCLUDE (wk), {O.change(plus, 'price')} AS {chg},
       CASE WHEN {O.change(plus, 'price')} > 0 THEN 1 ELSE 0 END AS target{extra}
FROM l {tail}"""


@query("features_1h", ("AGG-1", "WIN-1", "FLT-3", "WIN-3", "SCL-12"),
       oracle=_label_oracle("1 hour", HOURLY, 1, "1h"))
def features_1h(spark, sf_dir):
    """Flagship: hourly bars per symbol -> lagged changes (1h..24h) in week
    partitions -> null drop -> next-hour direction label."""
    return L.feature_table(_bars(spark, sf_dir, "1 hour"), "1 hour", HOURLY,
                           label_horizon="1 hour")


@query("label_up", ("WIN-1", "FLT-3", "WIN-3", "SCL-12", "Q5"),
       oracle=_label_oracle("5 minutes", REF, 3, "15m"))
def label_up(spark, sf_dir):
    """Reference feature set: 5-minute bars, six changes, 15-minute label;
    the week's last bars have no future price and are labelled 0."""
    return L.feature_table(_bars(spark, sf_dir), "5 minutes", REF)


RANGE = ("2024-01-13 00:00:00", "2024-01-20 12:00:00")


@query("label_up_range", ("FLT-1", "WIN-1", "WIN-3", "FLT-3"), oracle=f"""
SELECT * FROM ({_label_oracle("5 minutes", REF, 3, "15m")}) x
WHERE timestamp >= TIMESTAMP '{RANGE[0]}' AND timestamp < TIMESTAMP '{RANGE[1]}'""")
def label_up_range(spark, sf_dir):
    """label_up rows for one time range, computed from only the ticks of the
    week partitions that overlap it (the range filter reaches the scan)."""
    return L.feature_table_between(read_ticks(spark, sf_dir), RANGE[0], RANGE[1], "5 minutes",
                                   REF)


@query("label_up_drop_tail", ("WIN-3", "Q5"),
       oracle=_label_oracle("5 minutes", REF, 3, "15m", drop_tail=True))
def label_up_drop_tail(spark, sf_dir):
    """As label_up, but rows without a future price are dropped."""
    return L.feature_table(_bars(spark, sf_dir), "5 minutes", REF, unlabeled="drop")


@query("past_direction", ("SCL-12", "Q28", "PRJ-7"), oracle=f"""
SELECT * EXCLUDE (wk, percent_change_15m),
       CASE WHEN percent_change_15m > 0 THEN 1 ELSE 0 END AS past_direction
FROM ({_WEEK_LAGS}) x WHERE {O.not_null(_REF_NAMES)}""")
def past_direction(spark, sf_dir):
    """Direction of the current 15-minute change, source column dropped."""
    f = G.drop_incomplete(G.pct_change_features(_bars(spark, sf_dir), REF, "5 minutes"))
    return L.past_direction(f, drop_source=True)


# --------------------------------------------------------------------------- index
@query("dense_row_index", ("WIN-8",), oracle="""
SELECT event_id, event_type, ts,
       row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx
FROM events""")
def dense_row_index(spark, sf_dir):
    """Dense 0-based position of every event within its type, by time,
    always through the quantile-slice plan (no size shortcut), so this check
    covers the path used for series too large for one task."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "ts"])
    return dense_index(ev, ["ts", "event_id"], keys=["event_type"], out="idx",
                       max_group_rows=None)
