"""Streaming queries: the events table replayed as a file stream and run to
completion with ``availableNow``; results read back from the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.ml import model as ML
from tickflow.plans import oracle_sql as O
from tickflow.plans.models import TEST_ROWS_SQL, fitted
from tickflow.plans.registry import query
from tickflow.session import scratch_path, stage, table_path
from tickflow.sources import events as E
from tickflow.sources import ticks as K
from tickflow.functions.change import direction
from tickflow.operators import lags as G
from tickflow.plans.series import REF, _bars
from tickflow.streaming import corrections as CO
from tickflow.streaming import frames as FR
from tickflow.streaming import stateful as SF
from tickflow.streaming import stream as ST
from tickflow.streaming import upsert as UP

DELAY = "10 minutes"


def event_stream(spark, sf_dir):
    path = table_path(sf_dir, "events")
    return ST.file_stream(spark, path, spark.read.parquet(path).schema)


@query("stream_parse", ("STR-1", "STR-2", "STR-4", "SNK-2", "PRJ-2", "PRJ-3"), oracle="""
SELECT event_id, value AS price, CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS market_cap,
       event_type AS symbol, ts AS timestamp
FROM events WHERE event_type NOT IN ('error', 'signup')""")
def stream_parse(spark, sf_dir):
    """Tick JSON messages parsed on a stream; valid ticks to a Parquet sink."""
    docs = E.tick_documents(event_stream(spark, sf_dir))
    good, _ = K.split_valid(K.parse_ticks(docs, keep=["event_id"]))
    out = good.select("event_id", "price", "market_cap", "symbol",
                      F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    return ST.run_available(out, spark, "stream_parse")


@query("stream_bars", ("AGG-1", "STR-2", "SNK-2"), oracle=f"""
SELECT * FROM ({O.bars('1 hour')}) b
WHERE timestamp <= (SELECT max(ts) FROM events) - INTERVAL '{DELAY}'""")
def stream_bars(spark, sf_dir):
    """Hourly bars as a streaming aggregate with a 10-minute watermark in
    append mode: every bar whose end the watermark has passed."""
    ticks = E.ticks_from_events(event_stream(spark, sf_dir))
    b = ST.streaming_bars(ticks, "1 hour", DELAY)
    out = b.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return ST.run_available(out, spark, "stream_bars")


@query("stream_bars_complete", ("AGG-1", "STR-3"), oracle=O.bars("1 hour"))
def stream_bars_complete(spark, sf_dir):
    """Hourly bars in complete output mode (the whole result table)."""
    ticks = E.ticks_from_events(event_stream(spark, sf_dir))
    b = ST.streaming_bars(ticks, "1 hour", DELAY)
    out = b.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return ST.run_available(out, spark, "stream_bars_complete", mode="complete")


def tick_messages(features):
    """Stand-in feed: one binary message per feature row, changes in percent."""
    from tickflow.functions.jsoncols import encode
    body = encode("price", "symbol", F.date_format(
        "timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        *[(F.col(c) * 100).alias(c) for c in ML.feature_columns(features)])
    return features.select(F.col("symbol").cast("binary").alias("key"),
                           body.cast("binary").alias("value"))


def scored_ticks(messages, model):
    """Binary tick messages -> text -> fields -> fractions -> scored ticks."""
    parsed = K.parse_ticks(K.as_text(messages, key="key"), keep=["key"])
    good, _ = K.split_valid(parsed)
    return ML.predict(model, K.percent_to_fraction(good))


@query("stream_score", ("STR-5", "ML-4", "PRJ-1", "PRJ-14", "Q10"), oracle=TEST_ROWS_SQL + """
SELECT symbol, timestamp, price, true AS scored FROM l, c WHERE timestamp >= cut""")
def stream_score(spark, sf_dir):
    """Tick messages of the test period (key and value bytes, changes in
    percent) read as a stream, parsed, turned into fractions and scored by
    the saved and reloaded model, whole micro-batches at a time."""
    model, _, _, test = fitted(spark, sf_dir)
    model = ML.load_model(ML.save_model(model, scratch_path(spark, "model")))
    landing = scratch_path(spark, "messages")
    tick_messages(test).write.mode("overwrite").parquet(landing)
    s = ST.file_stream(spark, landing, spark.read.parquet(landing).schema)
    scored = scored_ticks(s, model).select(
        "symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "price",
        F.col("prediction").isin(0.0, 1.0).alias("scored"))
    return ST.run_available(scored, spark, "stream_score")


@query("stream_lags", ("WIN-1", "STR-2", "EXT"), oracle=f"""
SELECT * EXCLUDE (wk), false AS late FROM ({O.week_lags(O.bars('5 minutes'), REF, '5 minutes')}) x""")
def stream_lags(spark, sf_dir):
    """Week-partitioned lagged changes computed on a stream: 5-minute bars
    arrive in ``LAG_DROPS`` parts of equal length of their own time extent,
    each part a run of the same stream, with lags carried across runs in
    per-(symbol, week) state."""
    return stream_lags_of(spark, _bars(spark, sf_dir))


LAG_DROPS = 6


def stream_lags_of(spark, bars, drops: int = LAG_DROPS):
    bars = stage(bars)
    landing, root = scratch_path(spark, "bars_landing"), scratch_path(spark, "stream_lags")
    lo, hi = bars.agg(F.min("timestamp"), F.max("timestamp")).first()
    edges = [None if lo is None else lo + (hi - lo) * i / drops for i in range(1, drops)]
    at = F.col("timestamp")
    part = F.lit(0)
    for e in edges if lo is not None else []:
        part = part + F.when(at > F.lit(e).cast("timestamp_ntz"), 1).otherwise(0)
    numbered, out = bars.withColumn("_part", part), None
    for i in range(drops):
        numbered.filter(F.col("_part") == i).drop("_part").write.mode("append").parquet(landing)
        s = ST.file_stream(spark, landing, bars.schema)
        s = s.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        rows = SF.stream_lag_features(s, REF, "5 minutes").withColumn(
            "timestamp", F.col("timestamp").cast("timestamp_ntz"))
        out = ST.run_available(rows, spark, "stream_lags", root=root)
    return out


@query("stream_dedup", ("FLT-4", "STR-2", "EXT"), oracle="""
SELECT event_id, ts, event_type, value FROM events""")
def stream_dedup(spark, sf_dir):
    """Every event delivered twice (the stream unioned with itself, as an
    at-least-once producer would), deduplicated on the stream by event id
    within a 10-minute watermark."""
    s = event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    d = ST.dedup_within_watermark(s.unionByName(s), ["event_id"], "ts", DELAY)
    out = d.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return ST.run_available(out, spark, "stream_dedup")


@query("stream_quarantine", ("STR-1", "SNK-2", "Q16"), oracle="""
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'no_timestamp' END AS reason,
       event_type = 'error' AS text_is_null
FROM events WHERE event_type IN ('error', 'signup')""")
def stream_quarantine(spark, sf_dir):
    """Tick messages parsed on a stream; each micro-batch splits into a valid
    sink and a quarantine sink holding the raw text and the reason. Returns
    the quarantine (raw text reduced to whether it was the literal null)."""
    docs = E.tick_documents(event_stream(spark, sf_dir))
    _, bad = ST.run_split_available(K.parse_ticks(docs, keep=["event_id"]), spark,
                                    "stream_quarantine")
    return bad.select("event_id", "reason", (F.col("json_string") == "null").alias("text_is_null"))


def by_time(df, drops: int, at: str = "timestamp", part: str = "_part"):
    """``part``: 0 to drops - 1, equal lengths of the data's own time extent."""
    lo, hi = df.agg(F.min(at), F.max(at)).first()
    if lo is None or hi == lo:
        return df.withColumn(part, F.lit(0)), 0
    seconds = (hi - lo).total_seconds()
    since = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(
        F.lit(lo).cast("timestamp"))
    n = F.floor(since * F.lit(drops) / F.lit(seconds * 1e6)).cast("int")
    return df.withColumn(part, F.least(n, F.lit(drops - 1))), seconds


def land(df, path: str):
    """One drop: its rows become new files of a landing folder."""
    df.write.mode("append").parquet(path)


def as_stream(spark, path: str, schema, at: str = "timestamp"):
    return ST.file_stream(spark, path, schema).withColumn(at, F.col(at).cast("timestamp"))


HELD_BACK = 5           # one bar in five is sent a drop late
CORRECTED_DROPS = 3


@query("stream_lags_corrected", ("WIN-1", "STR-2", "EXT"), oracle=f"""
SELECT * EXCLUDE (wk, volume) FROM ({O.week_lags(O.bars('5 minutes'), REF, '5 minutes')}) x""")
def stream_lags_corrected(spark, sf_dir):
    """Lagged changes on a stream whose late bars correct later ones: bars
    arrive in ``CORRECTED_DROPS`` runs, one in ``HELD_BACK`` of them a run late; the
    upserted rows end in the batch answer."""
    bars = stage(_bars(spark, sf_dir))
    numbered, seconds = by_time(bars, CORRECTED_DROPS)
    late = F.pmod(F.xxhash64("symbol", "timestamp"), F.lit(HELD_BACK)) == 0
    numbered = numbered.withColumn("_part", F.col("_part") + F.when(late, 1).otherwise(0))
    delay = f"{int(2 * seconds / CORRECTED_DROPS) + 600} seconds"
    landing, root = scratch_path(spark, "late_landing"), scratch_path(spark, "late_lags")
    table = None
    for i in range(CORRECTED_DROPS + 1):
        land(numbered.filter(F.col("_part") == i).drop("_part"), landing)
        rows = CO.corrected_lag_features(as_stream(spark, landing, bars.schema), REF, "5 minutes",
                                         delay=delay)
        table = UP.run_upsert(rows, spark, root, ["symbol", "timestamp"], mode="update")
    return table.read().withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("stream_rolling", ("WIN-4", "AGG-2", "AGG-1", "STR-2", "EXT"), oracle=f"""
WITH b AS ({O.bars('5 minutes')})
SELECT a.symbol, a.timestamp, a.price,
       CAST(SUM(CAST(c.volume AS DECIMAL(28,8))) AS DOUBLE) AS volume_24h
FROM b a LEFT JOIN b c ON c.symbol = a.symbol AND c.timestamp <= a.timestamp
     AND c.timestamp > a.timestamp - INTERVAL '24 hours'
WHERE a.timestamp <= (SELECT max(ts) FROM events) - INTERVAL '{DELAY}'
GROUP BY 1, 2, 3""")
def stream_rolling(spark, sf_dir):
    """Rolling 24-hour volume of 5-minute bars on a stream of ticks: panes, then
    frames over panes, under one watermark; equals ``rolling_24h_join`` for
    every bar the watermark has passed."""
    ticks = E.ticks_from_events(event_stream(spark, sf_dir))
    out = FR.streaming_rolling(ticks, "5 minutes", "24 hours", DELAY)
    out = out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return ST.run_available(out, spark, "stream_rolling")


LATER, LATER_DELAY, LATER_DROPS = "15 minutes", "12 minutes", 3


@query("stream_join_later", ("JON-2", "JON-3", "STR-2", "EXT"), oracle=f"""
WITH b AS ({O.bars('5 minutes')}),
l AS (SELECT symbol, timestamp, price, CASE WHEN percent_change_15m > 0 THEN 1 ELSE 0 END AS prediction
      FROM ({O.week_lags(O.bars('5 minutes'), ['15 minutes'], '5 minutes')}) k)
SELECT l.*, b.price AS later_price FROM l LEFT JOIN b
  ON b.symbol = l.symbol AND b.timestamp = l.timestamp + INTERVAL '{LATER}'
WHERE b.price IS NOT NULL OR l.timestamp + INTERVAL '{LATER}'
      < (SELECT max(timestamp) FROM b) - INTERVAL '{LATER_DELAY}'""")
def stream_join_later(spark, sf_dir):
    """Predictions of a rule joined on a stream to the bar 15 minutes later;
    bars and predictions arrive in ``LATER_DROPS`` runs. A prediction without
    such a bar appears once, when the watermark has passed its time."""
    bars = stage(_bars(spark, sf_dir))
    lagged = G.pct_change_features(bars, ["15 minutes"], "5 minutes")
    preds = stage(lagged.select("symbol", "timestamp", "price", direction(
        F.col("percent_change_15m")).alias("prediction")))
    root, out = scratch_path(spark, "stream_join"), None
    landed = {"bars": bars, "preds": preds}
    for i in range(LATER_DROPS):
        for name, df in landed.items():
            part = by_time(df, LATER_DROPS)[0].filter(F.col("_part") == i).drop("_part")
            land(part, f"{root}/{name}")
        j = FR.join_later(as_stream(spark, f"{root}/preds", preds.schema),
                          as_stream(spark, f"{root}/bars", bars.schema), LATER, delay=LATER_DELAY)
        out = ST.run_available(
            j.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), spark,
            "stream_join", root=f"{root}/run")
    return out


@query("stream_append", ("SET-2", "STR-4", "EXT"), oracle="""
SELECT event_id, ts, event_type, value FROM events""")
def stream_append(spark, sf_dir):
    """Idempotent append: the events table as a stream, written by event id;
    the whole table is then sent once more as a later batch, and everything
    is folded into one base. No event is there twice."""
    root = scratch_path(spark, "stream_append")
    s = event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    table = UP.run_upsert(s, spark, root, ["event_id"])
    again = 1 + max(table.parts()[1], default=0)
    table.write(spark.read.parquet(table_path(sf_dir, "events")), again)
    table.compact()
    return table.read()
