"""DuckDB SQL fragments for the oracle side of each query.

These are written independently of the Spark code, in plain SQL over the
pre-registered views, so that a mistake in a transform cannot hide in both.
"""

from __future__ import annotations

from tickflow.functions.temporal import duration_label, duration_seconds


def ticks(single_series: bool = False) -> str:
    sym = "'ALL'" if single_series else "event_type"
    return (f"SELECT {sym} AS symbol, ts, value AS close, value AS volume, "
            f"event_id AS tiebreak FROM events")


def bars(width: str = "5 minutes", single_series: bool = False) -> str:
    s = duration_seconds(width)
    return f"""
SELECT symbol,
       time_bucket(INTERVAL '{s} seconds', ts, TIMESTAMP '1970-01-01')
         + INTERVAL '{s} seconds' AS timestamp,
       arg_max(close, (ts, tiebreak)) AS price,
       CAST(SUM(CAST(volume AS DECIMAL(28,8))) AS DOUBLE) AS volume
FROM ({ticks(single_series)}) t
GROUP BY 1, 2"""


def week(col: str = "timestamp") -> str:
    return f"time_bucket(INTERVAL '7 days', {col}, TIMESTAMP '1970-01-01')"


def change(cur: str, prev: str) -> str:
    return f"(({cur}) - ({prev})) / NULLIF(({prev}), 0)"


def lag_names(horizons, width: str, prefix: str = "percent_change_"):
    w = duration_seconds(width)
    out = []
    for h in horizons:
        sec = h * w if isinstance(h, int) else duration_seconds(h)
        out.append((f"{prefix}{duration_label(sec)}", sec // w, sec))
    return out


def week_lags(src: str, horizons, width: str, extra_cols: str = "") -> str:
    """Lagged fractional changes inside (symbol, week) partitions."""
    cols = ",\n       ".join(
        f"{change('price', f'lag(price, {k}) OVER w')} AS {name}"
        for name, k, _ in lag_names(horizons, width))
    return f"""
SELECT *{extra_cols},
       {cols}
FROM (SELECT *, {week()} AS wk FROM ({src}) b) k
WINDOW w AS (PARTITION BY symbol, wk ORDER BY timestamp)"""


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)
