"""Values that once got lost: decimals, odd numbers, nulls, header order."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import T, bars_df, ticks_df
from tickflow.operators import bars as B
from tickflow.operators import lags as G
from tickflow.operators import metrics as M
from tickflow.operators import rolling as R
from tickflow.operators.index import dense_index
from tickflow.plans.streams import stream_lags_of
from tickflow.session import checkpoint_dir, scratch_path
from tickflow.sources import files as FS

HOUR = [f"2024-01-01 {h:02d}:00:00" for h in range(24)]


def test_rolling_plans_agree_on_eight_decimals_and_both_sides_of_the_size_check(spark):
    df = bars_df(spark, [("a", h, 1.0, round(0.12345678 * (i + 1), 8)) for i, h in enumerate(HOUR)])
    want = {}
    for i in range(24):
        want[i] = math.fsum(round(0.12345678 * (k + 1), 8) for k in range(max(0, i - 3), i + 1))
    plans = [R.rolling_sum(df, "volume", "3 hours", out="v", max_group_rows=n) for n in (2_000_000, 3)]
    plans += [R.rolling_sum(df, "volume", "3 hours", out="v", method=m) for m in ("halo", "slices")]
    got = [[r["v"] for r in p.orderBy("timestamp").collect()] for p in plans]
    assert all(g == got[0] for g in got)
    assert got[0] == pytest.approx([want[i] for i in range(24)], rel=1e-15)
    joined = R.rolling_join(df, "volume", "3 hours", out="v", closed="both")
    assert [r["v"] for r in joined.orderBy("timestamp").collect()] == got[0]


def test_odd_volumes_show_and_tiny_ones_stay(spark):
    ticks = ticks_df(spark, [("t", HOUR[0], 1, 3e-9, 1), ("t", HOUR[0], 1, 4e-9, 2),
                             ("n", HOUR[0], 1, 1, 1), ("n", HOUR[0], 1, float("nan"), 2),
                             ("i", HOUR[0], 1, float("inf"), 1), ("b", HOUR[0], 1, 1e21, 1)])
    got = {r["symbol"]: r["volume"] for r in B.bars(ticks, "1 hour").collect()}
    assert got["t"] == 7e-9 and math.isnan(got["n"]) and got["i"] == math.inf and got["b"] == 1e21
    rows = bars_df(spark, [("a", HOUR[i], 1.23e-9, v) for i, v in enumerate([1, float("nan"), 2, 3])])
    for m in ("halo", "slices"):
        v = [r["v"] for r in R.rolling_sum(rows, "volume", "1 hour", out="v", method=m)
             .orderBy("timestamp").collect()]
        assert v[0] == 1 and math.isnan(v[1]) and math.isnan(v[2]) and v[3] == 5
    ma = G.moving_average(rows, "price", 2, out="m").orderBy("timestamp").collect()
    assert ma[0]["m"] is None and ma[1]["m"] == 1.23e-9


def test_null_tiebreak_comes_first(spark):
    t = spark.createDataFrame(
        [("a", T(HOUR[0]), 1.0, 1.0, 5), ("a", T(HOUR[1]), 2.0, 1.0, None),
         ("b", T(HOUR[0]), 3.0, 1.0, None), ("b", T(HOUR[0]), 4.0, 1.0, -9)],
        "symbol string, ts timestamp_ntz, close double, volume double, tiebreak long")
    got = {r["symbol"]: r["price"] for r in B.bars(t, "2 hours").collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_csv_columns_by_header_and_rows_of_any_year(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, 10.0, T("2024-01-01")), (2, 20.0, None),
                                (3, 30.0, dt.datetime(999, 5, 1))],
                               "id long, close double, ts timestamp_ntz")
    FS.write_year_csvs(df.select("close", "ts", "id"), "ts", path)
    back = FS.read_year_csvs(spark, path, df.schema).select("id", "close")
    assert sorted(map(tuple, back.collect())) == [(1, 10.0), (2, 20.0), (3, 30.0)]
    with pytest.raises(ValueError, match="lacks"):
        FS.read_year_csvs(spark, path, df.withColumn("other", F.lit(1)).schema)


def test_curves_beyond_the_range_of_long_and_of_scores(spark):
    n = 10**10
    counts = spark.createDataFrame([(0.2, 0, n), (0.8, n, 0)], "score double, pos long, neg long")
    orig = M.score_counts
    M.score_counts = lambda *a: counts
    try:
        assert M.auc_roc(counts).first()["auc"] == 1.0
    finally:
        M.score_counts = orig
    df = spark.createDataFrame([(1, -7.0), (0, 9.0), (None, 0.5), (1, 0.5)], "target int, score double")
    assert M.roc_points(df).count() <= 101
    assert M.auc_roc(df).first()["n_neg"] == 1
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in M.pr_points(df, bins=None).collect()}
    assert pr == {9.0: (0.0, 0.0), 0.5: (0.5, 0.5), -7.0: (2 / 3, 1.0)}
    area = M.auc_pr(df).first()["area"]
    assert area == pytest.approx(0.5 * (0 + 0.5) / 2 + 0.5 * (0.5 + 2 / 3) / 2)


@pytest.mark.parametrize("days", [0, 20, 60])
def test_stream_lags_equal_batch_lags_wherever_the_dates_lie(spark, days):
    rows = [("a", str(dt.datetime(2024, 1, 1) + dt.timedelta(days=days, hours=7 * i)), 1.0 + i)
            for i in range(30)]
    df = bars_df(spark, rows)
    want = {r["timestamp"]: r["percent_change_24h"] for r in G.pct_change_features(
        df, G.REFERENCE_HORIZONS, "5 minutes").collect()}
    got = {r["timestamp"]: r["percent_change_24h"] for r in stream_lags_of(spark, df, 3).collect()}
    assert got == want


def test_one_hot_timestamp_is_numbered_across_slices(spark):
    df = spark.range(500).select(F.lit(T(HOUR[0])).alias("ts"), "id")
    got = dense_index(df, ["ts", "id"], max_group_rows=None, partitions=4).collect()
    assert sorted(r["idx"] for r in got) == list(range(500))


def test_raw_ticks_are_kept_out_of_the_range_join(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_BUCKET_ROWS", 10)
    df = bars_df(spark, [("a", "2024-01-01 00:00:00", 1.0)] * 11)
    with pytest.raises(ValueError, match="rolling_sum"):
        R.rolling_join(df, "volume", "24 hours")


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
