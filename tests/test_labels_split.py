import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01, bars_df
from tickflow.operators import split as S
from tickflow.operators.labels import direction_label, feature_table, past_direction
from tickflow.operators.lags import pct_change_features
from tickflow.plans.series import _bars


def test_week_tail_labelled_zero_or_dropped(spark):
    base = dt.datetime(2024, 1, 4)  # Thursday
    rows = [("A", str(base + dt.timedelta(minutes=5 * i)), 100 + i) for i in range(10)]
    b = bars_df(spark, rows)
    z = direction_label(b, "15 minutes", "5 minutes").orderBy("timestamp").collect()
    assert [r["target"] for r in z] == [1] * 7 + [0] * 3
    assert all(r["price_plus_15m"] is None for r in z[-3:])
    d = direction_label(b, "15 minutes", "5 minutes", unlabeled="drop")
    assert d.count() == 7


def test_label_uses_rows_after_null_drop(spark):
    b = _bars(spark, SF01)
    f = feature_table(b, "5 minutes")
    assert f.filter(F.col("percent_change_24h").isNull()).count() == 0
    assert set(f.columns) >= {"price_plus_15m", "price_change_15m", "target"}


def test_past_direction(spark):
    b = bars_df(spark, [("A", "2024-01-01 00:00:00", 1), ("A", "2024-01-01 00:05:00", 2),
                        ("A", "2024-01-01 00:10:00", 1)])
    f = past_direction(pct_change_features(b, [1], "5 minutes"), "percent_change_5m")
    assert [r["past_direction"] for r in f.orderBy("timestamp").collect()] == [0, 1, 0]


def test_hash_split_stable_and_disjoint(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    key = F.col("event_id")
    a = S.with_validation_flag(ev, key).select("event_id", "isVal")
    b = S.with_validation_flag(ev.repartition(13), key).select("event_id", "isVal")
    assert a.exceptAll(b).count() == 0
    frac = a.filter("isVal").count() / a.count()
    assert 0.17 < frac < 0.23
    tr, va = S.split_hash(ev, key)
    assert tr.count() + va.count() == ev.count()
    assert tr.join(va, "event_id").count() == 0


def test_year_split_is_partition_of_rows(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    train, test = S.split_by_year(o, "o_orderdate", 2000)
    assert train.count() + test.count() == o.count()
    assert test.filter(F.year("o_orderdate") != 2000).count() == 0
    early, _ = S.split_by_year(o, "o_orderdate", 2000, train_before=True)
    assert early.filter(F.year("o_orderdate") >= 2000).count() == 0


import pytest  # noqa: E402


@pytest.mark.parametrize("start,end", [("2024-01-11 00:00:00", "2024-01-18 00:00:00"),
                                       ("2024-01-09 07:35:00", "2024-01-12 00:05:00"),
                                       ("2024-01-01 00:00:00", "2024-01-31 00:00:00")])
def test_range_feature_table_equals_full_then_cut(spark, start, end):
    from tickflow.operators.labels import feature_table_between
    from tickflow.sources.events import read_ticks
    full = feature_table(_bars(spark, SF01), "5 minutes").filter(
        (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
    part = feature_table_between(read_ticks(spark, SF01), start, end, "5 minutes")
    assert part.count() == full.count() > 0
    assert part.exceptAll(full).count() == 0 and full.exceptAll(part).count() == 0
