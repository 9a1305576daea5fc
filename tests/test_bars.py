import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, T, bars_df, ticks_df
from tickflow.operators.bars import bars, gap_fill
from tickflow.sources.events import read_ticks


def test_last_price_ties_broken_by_tiebreak(spark):
    t = ticks_df(spark, [("A", "2024-01-01 00:01:00", 10, 1, 1),
                         ("A", "2024-01-01 00:03:00", 11, 1, 7),
                         ("A", "2024-01-01 00:03:00", 12, 1, 5)])
    b = bars(t, "5 minutes").collect()
    assert len(b) == 1 and b[0]["price"] == 11.0 and b[0]["volume"] == 3.0
    assert b[0]["timestamp"] == T("2024-01-01 00:05:00")


def test_tick_on_window_edge_starts_next_bar(spark):
    t = ticks_df(spark, [("A", "2024-01-01 00:04:59", 1, 1, 1),
                         ("A", "2024-01-01 00:05:00", 2, 1, 2)])
    b = bars(t, "5 minutes").orderBy("timestamp").collect()
    assert [r["timestamp"] for r in b] == [T("2024-01-01 00:05:00"), T("2024-01-01 00:10:00")]
    assert [r["price"] for r in b] == [1.0, 2.0]


def test_year_end_bar_belongs_to_next_year(spark):
    t = ticks_df(spark, [("A", "2023-12-31 23:57:00", 1, 1, 1)])
    assert bars(t, "5 minutes").first()["timestamp"] == T("2024-01-01 00:00:00")


def test_bar_volume_equals_tick_volume(spark):
    t = read_ticks(spark, SF001)
    b = bars(t, "5 minutes")
    tv = t.agg(F.sum(F.col("volume").cast("decimal(28,8)"))).first()[0]
    bv = b.agg(F.sum(F.col("volume").cast("decimal(28,8)"))).first()[0]
    assert tv == bv
    assert b.count() == b.select("symbol", "timestamp").distinct().count()


def test_gap_fill_keeps_empty_slots(spark):
    b = bars_df(spark, [("A", "2024-01-01 01:00:00", 1), ("A", "2024-01-01 04:00:00", 4),
                        ("B", "2024-01-01 02:00:00", 2)])
    g = gap_fill(b, "1 hour").orderBy("symbol", "timestamp").collect()
    a = [(r["timestamp"].hour, r["price"]) for r in g if r["symbol"] == "A"]
    assert a == [(1, 1.0), (2, None), (3, None), (4, 4.0)]
    assert [r["price"] for r in g if r["symbol"] == "B"] == [2.0]


def test_gap_fill_spans_many_chunks(spark):
    start = dt.datetime(2024, 1, 1)
    b = bars_df(spark, [("A", str(start), 1), ("A", str(start + dt.timedelta(days=3)), 2)])
    assert gap_fill(b, "5 minutes").count() == 3 * 288 + 1


def test_gap_fill_null_key_series(spark):
    b = bars_df(spark, [(None, "2024-01-01 01:00:00", 1), (None, "2024-01-01 03:00:00", 3)])
    g = gap_fill(b, "1 hour").orderBy("timestamp").collect()
    assert [(r["symbol"], r["timestamp"].hour, r["price"]) for r in g] == [
        (None, 1, 1.0), (None, 2, None), (None, 3, 3.0)]
