import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickflow.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tickflow-tests", shuffle_partitions=4)
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def ticks_df(spark, rows):
    """rows: (symbol, 'YYYY-mm-dd HH:MM:SS', close, volume, tiebreak)."""
    return spark.createDataFrame(
        [(a, T(b), float(c), float(d), int(e)) for a, b, c, d, e in rows],
        "symbol string, ts timestamp_ntz, close double, volume double, tiebreak long")


def bars_df(spark, rows):
    """rows: (symbol, 'YYYY-mm-dd HH:MM:SS', price[, volume])."""
    out = []
    for r in rows:
        vol = float(r[3]) if len(r) > 3 else 1.0
        out.append((r[0], T(r[1]), None if r[2] is None else float(r[2]), vol))
    return spark.createDataFrame(out, "symbol string, timestamp timestamp_ntz, price double, "
                                      "volume double")


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
