import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import bars_df, rows
from tickflow.operators import lags as G
from tickflow.operators.index import dense_index


def test_week_partition_restarts_on_thursday(spark):
    # 2024-01-03 is a Wednesday, 2024-01-04 a Thursday.
    b = bars_df(spark, [("A", "2024-01-03 23:50:00", 100), ("A", "2024-01-03 23:55:00", 110),
                        ("A", "2024-01-04 00:00:00", 121), ("A", "2024-01-04 00:05:00", 133.1)])
    f = G.pct_change_features(b, [1], "5 minutes")
    got = [r["percent_change_5m"] for r in f.orderBy("timestamp").collect()]
    assert got[0] is None and got[2] is None
    assert got[1] == pytest.approx(0.1) and got[3] == pytest.approx(0.1)


def test_zero_price_gives_null_not_error(spark):
    b = bars_df(spark, [("A", "2024-01-01 00:00:00", 0.0), ("A", "2024-01-01 00:05:00", 5.0)])
    f = G.pct_change_features(b, [1], "5 minutes", partition=None).orderBy("timestamp").collect()
    assert f[1]["percent_change_5m"] is None


def test_fewer_rows_than_lag(spark):
    b = bars_df(spark, [("A", "2024-01-01 00:00:00", 1), ("A", "2024-01-01 00:05:00", 2)])
    f = G.pct_change_features(b, ["15 minutes"], "5 minutes").collect()
    assert all(r["percent_change_15m"] is None for r in f)
    assert G.drop_incomplete(G.pct_change_features(b, ["15 minutes"], "5 minutes")).count() == 0


def test_rows_mode_stretches_over_gaps_time_mode_does_not(spark):
    b = bars_df(spark, [("A", "2024-01-01 00:00:00", 100), ("A", "2024-01-01 00:05:00", 110),
                        ("A", "2024-01-01 00:20:00", 120)])
    r = G.pct_change_features(b, [1], "5 minutes").orderBy("timestamp").collect()
    t = G.pct_change_features(b, [1], "5 minutes", mode="time").orderBy("timestamp").collect()
    assert r[2]["percent_change_5m"] == pytest.approx(120 / 110 - 1)
    assert t[2]["percent_change_5m"] is None
    assert t[1]["percent_change_5m"] == pytest.approx(0.1)


def _random_bars(spark, n=700, symbols=("A", "B", "C")):
    """Irregular bar series (gaps of 1 to 6 slots) per symbol."""
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = []
    for s in symbols:
        minute = 0
        for _ in range(n):
            minute += rnd.choice([5, 5, 5, 10, 30])
            data.append((s, base + dt.timedelta(minutes=minute), round(rnd.uniform(1, 100), 2), 1.0))
    return spark.createDataFrame(data, "symbol string, timestamp timestamp_ntz, price double, "
                                       "volume double")


@pytest.mark.parametrize("parts,limit", [(1, None), (4, None), (13, None), (4, 10_000)])
def test_global_lags_match_single_window_any_partitioning(spark, parts, limit):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        b = _random_bars(spark)
        got = G.pct_change_features(b, [1, 7, 50], "5 minutes", partition=None, chunk_rows=64,
                                    max_group_rows=limit)
        w = Window.partitionBy("symbol").orderBy("timestamp")
        exp = b.select("*", *[F.try_divide(F.col("price") - F.lag("price", k).over(w),
                                           F.lag("price", k).over(w)).alias(f"e{k}")
                              for k in (1, 7, 50)])
        g = rows(got, ["symbol", "timestamp"])
        e = rows(exp, ["symbol", "timestamp"])
        assert len(g) == len(e)
        assert [r[4:] for r in g] == [r[4:] for r in e]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("parts,limit", [(1, None), (3, None), (13, None), (4, 10_000)])
def test_dense_index_is_row_number(spark, parts, limit):
    b = _random_bars(spark, n=300)
    got = dense_index(b, ["timestamp"], keys=["symbol"], partitions=parts, max_group_rows=limit)
    exp = got.withColumn("rn", F.row_number().over(
        Window.partitionBy("symbol").orderBy("timestamp")) - 1)
    assert exp.filter("idx != rn").count() == 0
    assert got.count() == b.count()


def test_leads_in_global_mode(spark):
    b = _random_bars(spark, n=200, symbols=("A",))
    got = G.row_shifts(b, {"nxt": ("price", -3)}, partition=None, chunk_rows=16,
                       max_group_rows=None)
    exp = got.withColumn("e", F.lead("price", 3).over(Window.partitionBy("symbol").orderBy("timestamp")))
    assert exp.filter(~F.col("nxt").eqNullSafe(F.col("e"))).count() == 0


def test_moving_average_null_until_full(spark):
    b = bars_df(spark, [("A", f"2024-01-01 00:{m:02d}:00", m) for m in range(0, 50, 2)])
    for limit in (None, 1000):
        r = G.moving_average(b, "price", 20, chunk_rows=4,
                             max_group_rows=limit).orderBy("timestamp").collect()
        assert all(x["ma_20"] is None for x in r[:19])
        assert r[19]["ma_20"] == pytest.approx(sum(range(0, 40, 2)) / 20)
        assert r[-1]["ma_20"] == pytest.approx(sum(range(10, 50, 2)) / 20)


def test_inverse_change_recovers_prior_price(spark):
    from tickflow.functions.change import prior_from_change
    b = _random_bars(spark, n=100, symbols=("A",))
    f = G.row_shifts(G.pct_change_features(b, [3], "5 minutes", keep_partition=True),
                     {"lagp": ("price", 3)})
    f = f.withColumn("back", prior_from_change(F.col("price"), F.col("percent_change_15m")))
    for r in f.filter("lagp is not null").collect():
        assert r["back"] == pytest.approx(r["lagp"], rel=1e-12)


def test_dense_index_with_many_slices_uses_bucketizer(spark):
    from tickflow.operators import index as I
    b = _random_bars(spark, n=700)
    old = I.CASE_LIMIT
    I.CASE_LIMIT = 8
    try:
        got = dense_index(b, ["timestamp"], keys=["symbol"], partitions=40, max_group_rows=None)
        exp = got.withColumn("rn", F.row_number().over(
            Window.partitionBy("symbol").orderBy("timestamp")) - 1)
        assert exp.filter("idx != rn").count() == 0 and got.count() == b.count()
    finally:
        I.CASE_LIMIT = old


def test_week_lags_on_untagged_input_with_big_groups_use_halo_plan(spark):
    b = _random_bars(spark, n=500)          # untagged: no bar width metadata
    plain = G.pct_change_features(b, [1, 3, 12], "5 minutes", max_group_rows=10_000)
    halo = G.pct_change_features(b, [1, 3, 12], "5 minutes", max_group_rows=5, chunk_rows=16)
    assert plain.count() == halo.count() == b.count()
    assert plain.exceptAll(halo).count() == 0 and halo.exceptAll(plain).count() == 0


def test_bar_width_metadata_proves_week_bound(spark):
    from conftest import SF001
    from tickflow.operators.bars import bar_width_of
    from tickflow.plans.series import _bars
    b = _bars(spark, SF001)
    assert bar_width_of(b, "timestamp") == 300
    f = G.pct_change_features(b, ["15 minutes"], "5 minutes", keep_partition=True)
    assert bar_width_of(f, "timestamp") == 300


def test_dense_index_keeps_null_key_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(minutes=i), float(i)) for s in ("A", None) for i in range(50)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, price double")
    got = dense_index(df, ["timestamp"], keys=["symbol"], partitions=7, max_group_rows=None)
    assert got.count() == 100
    for s in ("A", None):
        part = got.filter(F.col("symbol").eqNullSafe(F.lit(s))).orderBy("timestamp")
        assert [r["idx"] for r in part.collect()] == list(range(50))
