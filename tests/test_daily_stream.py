import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from tickflow.operators import daily as D
from tickflow.sources import events as E
from tickflow.streaming import stream as ST
from tickflow.operators.bars import bars


def _preds(spark):
    d = dt.datetime(2024, 1, 1, 10)
    rows = [(1.0, 0.7, 10.0, d), (0.0, 0.2, 11.0, d + dt.timedelta(hours=1)),
            (1.0, 0.9, 12.0, d + dt.timedelta(days=2))]
    return spark.createDataFrame(rows, "label double, prob double, price double, time timestamp_ntz")


def test_daily_signal_and_empty_day(spark):
    s = D.daily_signal(_preds(spark)).orderBy("day").collect()
    assert [(r["buys"], r["n"], r["last_price"], r["buy_ratio"]) for r in s] == [
        (1.0, 2, 11.0, 0.5), (1.0, 1, 12.0, 1.0)]
    f = D.daily_signal_filled(_preds(spark)).orderBy("day").collect()
    assert [(r["day"].day, r["n"], r["buy_ratio"]) for r in f] == [(1, 2, 0.5), (2, 0, None),
                                                                   (3, 1, 1.0)]
    c = D.clip_ratio(D.daily_signal(_preds(spark)), 0.6).orderBy("day").collect()
    assert [r["buy_signal"] for r in c] == [0.0, 1.0]


def test_stream_bars_complete_equals_batch(spark):
    path = f"{SF001}/events.parquet"
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema)
    sb = ST.streaming_bars(E.ticks_from_events(s), "1 hour").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))
    got = ST.run_available(sb, spark, "test_stream_bars", mode="complete")
    exp = bars(E.read_ticks(spark, SF001), "1 hour")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_stream_parse_equals_batch(spark):
    from tickflow.sources import ticks as K
    path = f"{SF001}/events.parquet"
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema)
    out = K.parse_ticks(E.tick_documents(s), keep=["event_id"]).drop("json_string")
    got = ST.run_available(out, spark, "test_stream_parse")
    exp = K.parse_ticks(E.tick_documents(spark.read.parquet(path)), keep=["event_id"]).drop(
        "json_string")
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0


def test_stream_lags_across_batches_and_late_rows(spark):
    import datetime as dt

    from tickflow.streaming.stateful import stream_lag_features
    from tickflow.session import scratch_path
    base = dt.datetime(2024, 1, 4)  # Thursday: one week partition
    drops = [[0, 1, 2], [3, 4], [1, 5]]  # the last drop repeats an old slot -> late
    landing = scratch_path(spark, "test_lag_landing")
    for d in drops:
        rows = [("A", base + dt.timedelta(minutes=5 * i), float(100 + i), 1.0) for i in d]
        spark.createDataFrame(rows, "symbol string, timestamp timestamp, price double, "
                                    "volume double").coalesce(1).write.mode("append").parquet(landing)
    s = ST.file_stream(spark, landing, spark.read.parquet(landing).schema, max_files_per_trigger=1)
    out = ST.run_available(stream_lag_features(s, ["5 minutes", "10 minutes"], "5 minutes"),
                           spark, "test_lags")
    got = sorted(((r["timestamp"].minute, r["percent_change_5m"], r["late"]) for r in out.collect()),
                 key=lambda g: (g[2], g[0]))
    assert [g for g in got if not g[2]] == [
        (0, None, False), (5, 1 / 100, False), (10, 1 / 101, False), (15, 1 / 102, False),
        (20, 1 / 103, False), (25, 1 / 104, False)]
    assert [g for g in got if g[2]] == [(5, None, True)]


def test_console_sink_runs(spark, capsys):
    path = f"{SF001}/events.parquet"
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema)
    q = ST.console(s.select("event_id"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_kafka_connector_coordinates(spark):
    coord = ST.kafka_package(spark)
    assert coord.startswith("org.apache.spark:spark-sql-kafka-0-10_2.") and coord.endswith(
        spark.version)
