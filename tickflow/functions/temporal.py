"""Time scalars (SCL-1..7). All of them are built-in Spark expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "second": 1, "seconds": 1, "s": 1, "sec": 1,
    "minute": 60, "minutes": 60, "m": 60, "min": 60, "mins": 60,
    "hour": 3600, "hours": 3600, "h": 3600,
    "day": 86400, "days": 86400, "d": 86400,
    "week": 604800, "weeks": 604800, "w": 604800,
    "year": 31536000, "years": 31536000, "y": 31536000,
}


def duration_seconds(duration: str | int) -> int:
    """'5 minutes' -> 300; integers are taken as seconds."""
    if isinstance(duration, int):
        return duration
    m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", duration)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported duration: {duration!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def duration_label(seconds: int) -> str:
    """300 -> '5m', 3600 -> '1h', 86400 -> '24h' style feature suffixes."""
    for unit, size in (("y", 31536000), ("d", 86400), ("h", 3600), ("m", 60)):
        if unit == "d" and seconds < 7 * 86400:
            continue  # 24h reads better than 1d
        if seconds % size == 0:
            return f"{seconds // size}{unit}"
    return f"{seconds}s"


def as_utc(ts: Column) -> Column:
    """Timestamp (with or without zone) -> TIMESTAMP under the UTC session."""
    return ts.cast("timestamp")


def seconds_to_ts(unix: Column) -> Column:
    """SCL-1: unix seconds -> timestamp without a text round-trip (Q14)."""
    return F.timestamp_seconds(unix).cast("timestamp_ntz")


def ts_to_seconds(ts: Column) -> Column:
    """SCL-2: timestamp -> whole unix seconds."""
    return F.unix_seconds(as_utc(ts))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(as_utc(ts))


def parse_ts(text: Column, fmt: str | None = None) -> Column:
    """SCL-3: text -> timestamp (ISO 8601 when no format is given)."""
    parsed = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def year_of(ts: Column) -> Column:
    """SCL-4."""
    return F.year(ts)


def minus(ts: Column, duration: str) -> Column:
    """SCL-7: interval subtraction, e.g. ``minus(ts, '24 hours')``."""
    return ts - F.expr(f"INTERVAL {duration_seconds(duration)} SECONDS")


def epoch_seconds_of(text: str) -> float:
    """UTC epoch seconds of an ISO date/time text (no zone means UTC)."""
    d = dt.datetime.fromisoformat(text)
    if d.tzinfo is None:
        d = d.replace(tzinfo=dt.timezone.utc)
    return d.timestamp()
