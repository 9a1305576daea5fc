import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from tickflow.operators.rolling import rolling_join, rolling_sum


def _bars(spark, n=400):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    data, m = [], 0
    for s in ("A", "B"):
        m = 0
        for _ in range(n):
            m += rnd.choice([5, 5, 60, 300, 1440])
            data.append((s, base + dt.timedelta(minutes=m), 1.0, round(rnd.uniform(0, 50), 2)))
    return data, spark.createDataFrame(
        data, "symbol string, timestamp timestamp_ntz, price double, volume double")


def _brute(data, closed):
    out = {}
    span = dt.timedelta(hours=24)
    for s, t, _, _ in data:
        tot = Decimal(0)
        for s2, t2, _, v in data:
            inside = (t - span <= t2 <= t) if closed == "both" else (t - span < t2 <= t)
            if s2 == s and inside:
                tot += Decimal(str(v))
        out[(s, t)] = float(tot)
    return out


@pytest.mark.parametrize("closed", ["both", "right"])
def test_rolling_window_matches_brute_force(spark, closed):
    data, df = _bars(spark)
    got = {(r["symbol"], r["timestamp"]): r["v24"]
           for r in rolling_sum(df, "volume", "24 hours", out="v24", closed=closed).collect()}
    assert got == _brute(data, closed)


def test_join_form_equals_window_form(spark):
    data, df = _bars(spark, 200)
    a = {(r["symbol"], r["timestamp"]): r["v"] for r in
         rolling_join(df, "volume", "24 hours", out="v", closed="right").collect()}
    b = {(r["symbol"], r["timestamp"]): r["v"] for r in
         rolling_sum(df, "volume", "24 hours", out="v", closed="right").collect()}
    assert a == b == _brute(data, "right")


def test_closed_frame_includes_exact_boundary(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 1.0, 1.0),
                                ("A", dt.datetime(2024, 1, 2), 1.0, 2.0)],
                               "symbol string, timestamp timestamp_ntz, price double, volume double")
    both = {r["timestamp"].day: r["v"] for r in rolling_sum(df, "volume", out="v").collect()}
    right = {r["timestamp"].day: r["v"] for r in
             rolling_sum(df, "volume", out="v", closed="right").collect()}
    assert both[2] == 3.0 and right[2] == 2.0


def _skewed(spark):
    """One hot series with many rows and repeated timestamps, plus small ones,
    and a null-key series."""
    rnd = random.Random(21)
    base = dt.datetime(2024, 1, 1)
    data = []
    for _ in range(1500):
        data.append(("HOT", base + dt.timedelta(minutes=rnd.randint(0, 3 * 1440)),
                     1.0, round(rnd.uniform(0, 9), 2)))
    for s in ("a", "b", None):
        for _ in range(60):
            data.append((s, base + dt.timedelta(minutes=rnd.randint(0, 3 * 1440)), 1.0,
                         round(rnd.uniform(0, 9), 2)))
    return data, spark.createDataFrame(
        data, "symbol string, timestamp timestamp_ntz, price double, volume double")


@pytest.mark.parametrize("closed", ["both", "right"])
@pytest.mark.parametrize("parts", [1, 7])
def test_sliced_rolling_sum_handles_skew_and_ties(spark, closed, parts):
    data, df = _skewed(spark)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = rolling_sum(df, "volume", "24 hours", out="v", closed=closed, method="slices")
        halo = rolling_sum(df, "volume", "24 hours", out="v", closed=closed, method="halo")
        assert got.count() == len(data)
        assert got.exceptAll(halo).count() == 0 and halo.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    exp = _brute(data, closed)
    for r in got.collect():
        assert r["v"] == pytest.approx(exp[(r["symbol"], r["timestamp"])], abs=1e-9)


def test_auto_picks_sliced_plan_when_groups_are_large(spark):
    data, df = _skewed(spark)
    small = rolling_sum(df, "volume", out="v", max_group_rows=100)   # forces slices
    big = rolling_sum(df, "volume", out="v")                          # halo
    assert small.exceptAll(big).count() == 0 and small.count() == len(data)


@pytest.mark.parametrize("closed", ["both", "right"])
@pytest.mark.parametrize("bps", [1, 3, 8])
def test_bucket_sum_join_matches_brute_force(spark, closed, bps):
    data, df = _bars(spark, 150)
    got = {(r["symbol"], r["timestamp"]): r["v"] for r in rolling_join(
        df, "volume", "24 hours", out="v", closed=closed, buckets_per_span=bps).collect()}
    assert got == _brute(data, closed)


def test_range_join_null_key_series(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(s, base + dt.timedelta(hours=3 * i), 1.0, float(i)) for s in ("A", None)
            for i in range(20)]
    df = spark.createDataFrame(data, "symbol string, timestamp timestamp_ntz, price double, "
                                     "volume double")
    got = {(r["symbol"], r["timestamp"]): r["v"] for r in
           rolling_join(df, "volume", "24 hours", out="v").collect()}
    assert got == _brute(data, "right")


@pytest.mark.parametrize("closed", ["both", "right"])
def test_large_finite_values_sum_in_every_plan(spark, closed):
    rnd, base = random.Random(5), dt.datetime(2024, 1, 1)
    data = [(s, base + dt.timedelta(hours=5 * i), 1.0,
             rnd.choice([round(rnd.uniform(0, 50), 2), -3.25, 1e12, 2.5e13, 1e15, 1e18, 7e24]
                        + ([1e30, -1e30, 3e200] if s == "HUGE" else [])))
            for s in ("A", "B", "HUGE") for i in range(60)]
    data += [("I", base + dt.timedelta(hours=5 * i), 1.0, v)
             for i, v in enumerate([1.0, float("inf"), float("nan"), *[1e13] * 12])]
    df = spark.createDataFrame(
        data, "symbol string, timestamp timestamp_ntz, price double, volume double")
    want, span = {}, dt.timedelta(hours=24)
    for s, t, _, _ in data:
        frame = [v for s2, t2, _, v in data if s2 == s and (
            t - span <= t2 <= t if closed == "both" else t - span < t2 <= t)]
        odd = any(v != v or abs(v) == float("inf") for v in frame)
        want[s, t] = float("nan") if odd else math.fsum(frame)
    plans = [rolling_sum(df, "volume", out="v", closed=closed, method=m)
             for m in ("auto", "halo", "slices")]
    plans.append(rolling_join(df, "volume", out="v", closed=closed))
    got = [{(r["symbol"], r["timestamp"]): r["v"] for r in p.collect()} for p in plans]
    for g in got:
        assert g == pytest.approx(want, rel=1e-15, nan_ok=True)
        assert {x: v for x, v in g.items() if v == v} == {x: v for x, v in got[0].items() if v == v}
    assert 0 < sum(v != v for v in want.values()) < 10
