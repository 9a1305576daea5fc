"""Streams with corrections, panes, joins, upserts and restarts, against batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators import lags as G
from tickflow.operators import rolling as R
from tickflow.operators.bars import bars
from tickflow.session import scratch_path
from tickflow.streaming import corrections as CO
from tickflow.streaming import frames as FR
from tickflow.streaming import stateful as SF
from tickflow.streaming import stream as ST
from tickflow.streaming import upsert as UP

BAR = "symbol string, timestamp timestamp, price double, volume double"
TICK = "symbol string, ts timestamp, close double, volume double, tiebreak long"
BASE = dt.datetime(2024, 1, 4)


def minutes(n):
    return BASE + dt.timedelta(minutes=n)


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --------------------------------------------------------------------------- upsert
def test_replayed_epoch_adds_nothing_and_compaction_keeps_rows(spark):
    schema = "k string, v long"
    t = UP.UpsertTable(spark, scratch_path(spark, "up"), spark.createDataFrame([], schema).schema,
                       ["k"])
    assert t.read().count() == 0
    one = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], schema)
    two = spark.createDataFrame([("a", 9), ("b", None)], schema)
    for batch, epoch in ((one, 0), (one, 0), (two, 1), (two, 1)):
        t.write(batch, epoch)
    want = {("a", 9), (None, 2), ("b", None)}
    assert t.read().count() == 3 and {tuple(r) for r in t.read().collect()} == want
    t.compact()
    assert t.parts() == (1, []) and {tuple(r) for r in t.read().collect()} == want
    t.write(one, 0)                                   # a replay of a folded epoch
    t.write(spark.createDataFrame([("b", 4)], schema), 2)
    t.compact()
    assert t.parts() == (2, [])
    assert {tuple(r) for r in t.read().collect()} == {("a", 9), (None, 2), ("b", 4)}


def test_unfinished_folder_is_not_read(spark):
    schema = spark.createDataFrame([], "k string, v long").schema
    t = UP.UpsertTable(spark, scratch_path(spark, "half"), schema, ["k"])
    t.write(spark.createDataFrame([("a", 1)], schema), 0)
    t.write(spark.createDataFrame([("a", 2)], schema), 1)
    fs, p = t._fs(f"{t.path}/epoch=1/{UP.DONE}")
    fs.delete(p, False)
    assert t.parts() == (None, [0]) and t.read().collect()[0]["v"] == 1


def test_failure_between_write_and_commit(spark):
    """The batch is written, then the run fails: the restart writes the same
    epoch again, and each row is there once."""
    landing, root = scratch_path(spark, "fail_in"), scratch_path(spark, "fail")
    land(spark, landing, [("a", 1), ("b", 2)], "k string, v long")
    s = ST.file_stream(spark, landing, spark.read.parquet(landing).schema)

    def breaks(table, batch, epoch):
        table.write(batch, epoch)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        UP.run_upsert(s, spark, root, ["k"], write=breaks)
    assert UP.UpsertTable(spark, f"{root}/table", s.schema, ["k"]).parts()[1] == [0]
    land(spark, landing, [("b", 5), ("c", 3)], "k string, v long")
    t = UP.run_upsert(s, spark, root, ["k"])
    got = sorted(tuple(r) for r in t.read().collect())
    assert [g[0] for g in got] == ["a", "b", "c"] and got[0][1] == 1 and got[2][1] == 3


# --------------------------------------------------------------------------- corrections
def test_late_rows_end_in_the_batch_answer(spark):
    rnd = random.Random(5)
    rows = [(s, minutes(5 * i), rnd.choice([0.0, None, 5.0, 7.5, 11.0]), 1.0)
            for s in ("A", "B", None) for i in range(60) if rnd.random() < 0.8]
    rnd.shuffle(rows)
    landing, root = scratch_path(spark, "late_in"), scratch_path(spark, "late")
    for i in range(3):
        land(spark, landing, rows[i::3] + rows[:2], BAR)        # some are sent again
        s = ST.file_stream(spark, landing, spark.read.schema(BAR).parquet(landing).schema)
        out = CO.corrected_lag_features(s, ["5 minutes", "20 minutes"], "5 minutes",
                                        delay="2 days")
        t = UP.run_upsert(out, spark, root, ["symbol", "timestamp"], mode="update")
    batch = spark.createDataFrame(rows, BAR).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))
    want = G.pct_change_features(batch, ["5 minutes", "20 minutes"], "5 minutes").drop("volume")
    got = t.read().withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    same(got.select(want.columns), want)


def test_corrected_price_replaces_the_old_one(spark):
    landing, root = scratch_path(spark, "fix_in"), scratch_path(spark, "fix")
    for rows in ([("A", minutes(5 * i), 100.0, 1.0) for i in range(4)],
                 [("A", minutes(5), 50.0, 1.0), ("A", None, 1.0, 1.0)]):
        land(spark, landing, rows, BAR)
        s = ST.file_stream(spark, landing, spark.read.schema(BAR).parquet(landing).schema)
        t = UP.run_upsert(CO.corrected_lag_features(s, ["5 minutes"], delay="1 day"), spark, root,
                          ["symbol", "timestamp"], mode="update")
    got = [r["percent_change_5m"] for r in t.read().orderBy("timestamp").collect()]
    assert got == [None, -0.5, 1.0, 0.0]


# --------------------------------------------------------------------------- panes
def test_rolling_stream_over_runs_equals_batch(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["A", None]), minutes(rnd.randrange(0, 4000)), rnd.random() * 9,
             rnd.choice([0.1, 0.2, None, 3e12]), i) for i in range(400)]
    rows.sort(key=lambda r: r[1])
    landing, root = scratch_path(spark, "roll_in"), scratch_path(spark, "roll")
    for i in range(2):
        land(spark, landing, rows[200 * i:200 * i + 200], TICK)
        s = ST.file_stream(spark, landing, spark.read.schema(TICK).parquet(landing).schema)
        got = ST.run_available(FR.streaming_rolling(s, "5 minutes", "6 hours", "7 minutes"),
                               spark, "roll", root=root)
    ticks = spark.createDataFrame(rows, TICK).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = R.rolling_join(bars(ticks, "5 minutes"), "volume", "6 hours", out="volume_24h")
    passed = max(r[1] for r in rows) - dt.timedelta(minutes=7)
    want = want.filter(F.col("timestamp") <= F.lit(passed).cast("timestamp_ntz"))
    got = got.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    key = lambda r: (r["symbol"] or "", r["timestamp"])
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert len(a) == len(b) > 100
    for x, y in zip(a, b):
        assert key(x) == key(y) and x["price"] == y["price"]
        assert x["volume_24h"] == (None if y["volume_24h"] is None
                                   else pytest.approx(y["volume_24h"], rel=1e-14))


# --------------------------------------------------------------------------- join
def test_unmatched_ticks_appear_once(spark):
    """Matches may come a run later; a tick without one is emitted once."""
    root = scratch_path(spark, "join")
    left = "symbol string, timestamp timestamp, guess int"
    runs = [([("A", minutes(0), 1), ("A", minutes(5), 0), (None, minutes(5), 1)],
             [("A", minutes(5), 1.0, 1.0)]),
            ([("A", minutes(30), 1)], [("A", minutes(15), 2.0, 1.0), (None, minutes(20), 3.0, 1.0)]),
            ([("A", minutes(300), 1)], [("A", minutes(300), 9.0, 1.0)])]
    for ticks, later in runs:
        land(spark, f"{root}/ticks", ticks, left)
        land(spark, f"{root}/bars", later, BAR)
        j = FR.join_later(ST.file_stream(spark, f"{root}/ticks", spark.read.schema(left).parquet(
            f"{root}/ticks").schema), ST.file_stream(spark, f"{root}/bars", spark.read.schema(
                BAR).parquet(f"{root}/bars").schema), delay="12 minutes")
        out = ST.run_available(j, spark, "join", root=f"{root}/run")
    got = sorted(((r["symbol"] or "", r["timestamp"], r["later_price"]) for r in out.collect()),
                 key=lambda r: r[:2])
    assert got == [("", minutes(5), 3.0), ("A", minutes(0), 2.0), ("A", minutes(5), None),
                   ("A", minutes(30), None)]


# --------------------------------------------------------------------------- restart
def _stopped_midway(df, root):
    """The run of ``run_available``, stopped after its first micro-batch."""
    spark = df.sparkSession
    with ST._TempConf(spark, ST._start_conf(spark, None, ST.ROCKSDB)):
        q = (df.writeStream.option("checkpointLocation", f"{root}/checkpoint").format("parquet")
             .option("path", f"{root}/out").outputMode("append")
             .trigger(processingTime="1 second").start())
    while not any(p["batchId"] >= 0 and p["numInputRows"] for p in q.recentProgress):
        assert q.isActive, q.exception()
        q.awaitTermination(0.2)
    q.stop()


@pytest.mark.parametrize("kind", ["parse", "bars", "lags"])
def test_stopped_run_goes_on_from_its_checkpoint(spark, kind):
    landing = scratch_path(spark, f"restart_{kind}")
    for d in range(4):
        at = [minutes(60 * d + 5 * i) for i in range(12)]
        rows = ([(f'{{"price": {d + i}.5, "symbol": "A", "timestamp": "{t.isoformat()}Z"}}',)
                 for i, t in enumerate(at)] if kind == "parse" else
                [("A", t, float(100 + d + i), 1.0, 12 * d + i) for i, t in enumerate(at)]
                if kind == "bars" else [("A", t, float(100 + d * 7 + i), 1.0)
                                        for i, t in enumerate(at)])
        land(spark, landing, rows, {"parse": "json_string string", "bars": TICK, "lags": BAR}[kind])
    schema = spark.read.parquet(landing).schema

    def job():
        s = ST.file_stream(spark, landing, schema, max_files_per_trigger=1)
        if kind == "parse":
            from tickflow.sources.ticks import parse_ticks
            return parse_ticks(s, fields=["price", "symbol", "timestamp"])
        if kind == "bars":
            return ST.streaming_bars(s, "10 minutes", "5 minutes")
        return SF.stream_lag_features(s, ["5 minutes", "15 minutes"], "5 minutes")

    root = scratch_path(spark, f"stopped_{kind}")
    _stopped_midway(job(), root)
    got = ST.run_available(job(), spark, kind, root=root)
    want = ST.run_available(job(), spark, f"whole_{kind}")
    assert got.count() == want.count() > 0
    same(got, want)
