"""Tables may name their columns as the operators name their own, and plans for
hot series give the results of the plain ones."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators import index as I
from tickflow.operators import labels as L
from tickflow.operators import lags as G
from tickflow.operators import rolling as R

NAMES = ["_b", "_us", "_halo", "_x", "_lag_x", "_lag_3", "_pid", "_series", "_local", "_w0", "_odd",
         "_t", "_kind", "_at", "_idx", "_part", "_chunk", "_bk", "_v0", "kept_b"]


@pytest.fixture(scope="module")
def bars(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 3, 4)
    rows = [(s, start + dt.timedelta(minutes=5 * i), rng.uniform(1, 9), rng.uniform(0, 5))
            for s in ("a", "b", None) for i in range(90) if rng.random() < 0.9]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, price double, "
                                       "volume double")


PLANS = {
    "rolling_halo": lambda d: R.rolling_sum(d, "volume", "1 hour", method="halo"),
    "rolling_slices": lambda d: R.rolling_sum(d, "volume", "1 hour", method="slices"),
    "rolling_auto": lambda d: R.rolling_sum(d, "volume", "1 hour"),
    "moving_average": lambda d: G.moving_average(d, "price", 4),
    "moving_average_halo": lambda d: G.moving_average(d, "price", 4, max_group_rows=None, chunk_rows=7),
    "time_shifts": lambda d: G.time_shifts(d, {"then": ("price", 900)}),
    "time_joins": lambda d: G.time_shifts(d, {"then": ("price", 900)}, max_group_rows=2),
    "pct_change": lambda d: G.pct_change_features(d, ["15 minutes", "1 hour"]),
    "pct_change_time": lambda d: G.pct_change_features(d, ["15 minutes"], mode="time"),
    "pct_change_global": lambda d: G.pct_change_features(d, [3], partition=None, max_group_rows=None,
                                                         chunk_rows=11),
    "lag_change": lambda d: G.lag_change(d, "volume"),
    "dense_index": lambda d: I.dense_index(d, ["timestamp"], keys=["symbol"]),
    "dense_index_slices": lambda d: I.dense_index(d, ["timestamp"], keys=["symbol"],
                                                  max_group_rows=None, partitions=4),
    "running_totals": lambda d: I.running_totals(d.fillna("n", ["symbol"]), ["timestamp", "symbol"],
                                                 ["volume"], max_group_rows=None, partitions=3),
    "label": lambda d: L.direction_label(d),
    "feature_table": lambda d: L.feature_table(d, horizons=["15 minutes", "30 minutes"]),
}


@pytest.mark.parametrize("plan", PLANS)
def test_columns_of_any_name_come_back(bars, plan):
    plain = PLANS[plan](bars)
    wide = bars
    for i, c in enumerate(NAMES):
        wide = wide.withColumn(c, F.lit(i))
    got = PLANS[plan](wide)
    kept = [c for c in NAMES if c != "_part" or plan != "label"]
    assert set(plain.columns) | set(kept) <= set(got.columns)
    assert len(got.columns) == len(set(got.columns))
    for r in got.select(*kept).distinct().collect():
        assert list(r) == [NAMES.index(c) for c in kept]
    a, b = (sorted(map(repr, d.select(*plain.columns).collect())) for d in (plain, got))
    assert a == b


def test_arguments_may_name_such_columns(bars):
    named = bars.withColumnsRenamed({"symbol": "_b", "volume": "_w0", "timestamp": "_us"})
    got = R.rolling_sum(named, "_w0", "1 hour", keys=["_b"], ts="_us", out="total", method="halo")
    want = R.rolling_sum(bars, "volume", "1 hour", out="total", method="halo")
    assert got.columns == ["_b", "_us", "price", "_w0", "total"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    join = R.rolling_join(named, "_w0", "1 hour", keys=["_b"], ts="_us", carry=("price",), out="total")
    plain = R.rolling_join(bars, "volume", "1 hour", carry=("price",), out="total")
    assert sorted(map(tuple, join.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_time_joins_take_the_largest_of_equal_times_like_the_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    rng = random.Random(1)
    rows = [(rng.choice(["a", None]), t0 + dt.timedelta(seconds=rng.randrange(40)),
             rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(200)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, price double")
    shifts = {"one": ("price", 1), "seven": ("price", 7)}
    window = G.time_shifts(df, shifts)
    joins = G.time_shifts(df, shifts, max_group_rows=2)
    assert sorted(map(repr, window.collect())) == sorted(map(repr, joins.collect()))
    best = {}
    for s, t, p in rows:
        if p is not None:
            best[s, t] = max(best.get((s, t), p), p)
    for r in joins.collect():
        assert r["seven"] == best.get((r["symbol"], r["timestamp"] - dt.timedelta(seconds=7)))
