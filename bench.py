"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through a no-op sink (nothing is collected),
once to warm up and then ``BENCH_REPEAT`` times; the median is reported.
Next to our plans, the same work in the reference's plan shape is timed on
the same machine (chained lag columns, nested-loop range self-join, a window
over the whole series in one task, metrics computed on collected rows), as

Prints exactly one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = [
    "bars_5m_by_symbol", "features_1h", "label_up", "pct_change_global", "pct_change_time_mode",
    "rolling_24h_join", "rolling_24h_range", "volume_change_rolling", "moving_avg_20",
    "daily_signal_filled", "auc_roc", "binary_metrics", "dedup_rows", "json_fields",
    "dense_row_index",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


ERRORS: dict[str, str] = {}


def _time(fn, repeat: int, name: str = "") -> float | None:
    """Median wall time of ``repeat`` warm runs; None (and the error noted)
    if the query fails, so the JSON line is always printed."""
    try:
        fn()
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        return round(statistics.median(times), 4)
    except Exception as e:  # noqa: BLE001
        ERRORS[name] = f"{type(e).__name__}: {str(e)[:300]}"
        return None


# --------------------------------------------------------------------------- reference-shaped plans
def ref_chained_lags(spark, sf_dir):
    """Reference plan shape: sort, 'last' after the sort, sort again, six lag
    columns added one by one over a window re-deriving the week, null drop,
    lead as lag(-3), label."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    t = ev.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("close"),
                  F.col("value").alias("vol")).orderBy("ts")
    b = (t.groupBy("symbol", F.window("ts", "5 minutes").alias("w"))
         .agg(F.last("close").alias("price"), F.sum("vol").alias("v")).orderBy(F.col("w.end"))
         .select("symbol", F.col("w.end").alias("timestamp"), "price", "v"))
    spec = Window.partitionBy("symbol", F.window("timestamp", "1 week")).orderBy("timestamp")
    from tickflow.functions.temporal import duration_seconds
    from tickflow.operators.lags import REFERENCE_HORIZONS
    for name, k in ((f"p{i}", duration_seconds(h) // 300) for i, h in enumerate(REFERENCE_HORIZONS)):
        # try_divide: plain division raises on a zero price under ANSI (Q22)
        b = b.withColumn(name, F.try_divide(F.col("price") - F.lag("price", k).over(spec),
                                            F.lag("price", k).over(spec)))
    b = b.na.drop().withColumn("plus", F.lag("price", -3).over(spec))
    return b.withColumn("target", F.when(
        F.try_divide(F.col("plus") - F.col("price"), F.col("price")) > 0, 1).otherwise(0))


def ref_nested_loop_rolling(spark, sf_dir):
    """Range self-join on the series key: Spark joins by hash, unlike the
    reference's key-less form below."""
    from pyspark.sql import functions as F
    from tickflow.plans.series import _bars
    b = _bars(spark, sf_dir)
    a, c = b.alias("a"), b.alias("c")
    j = a.join(c, (F.col("c.symbol") == F.col("a.symbol"))
               & (F.col("c.timestamp") <= F.col("a.timestamp"))
               & (F.col("c.timestamp") > F.col("a.timestamp") - F.expr("INTERVAL 24 HOURS")), "left")
    return j.groupBy("a.symbol", "a.timestamp").agg(F.sum("c.volume").alias("v24"))


def ref_nested_loop_rolling_nokey(spark, sf_dir):
    """The reference's one-series form: no key at all (nested-loop join)."""
    from pyspark.sql import functions as F
    from tickflow.plans.series import _bars
    b = _bars(spark, sf_dir, single=True)
    a, c = b.alias("a"), b.alias("c")
    j = a.join(c, (F.col("c.timestamp") <= F.col("a.timestamp"))
               & (F.col("c.timestamp") > F.col("a.timestamp") - F.expr("INTERVAL 24 HOURS")), "left")
    return j.groupBy("a.timestamp").agg(F.sum("c.volume").alias("v24"))


def ref_global_window_lags(spark, sf_dir):
    """Reference plan shape: lags over Window.orderBy(ts), one task."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tickflow.plans.series import _bars
    b = _bars(spark, sf_dir, single=True)
    w = Window.orderBy("timestamp")
    cols = [F.round(F.try_divide(F.col("price") - F.lag("price", k).over(w),
                                 F.lag("price", k).over(w)) * 100, 2)
            .alias(f"p{k}") for k in (1, 2, 3, 6, 12, 72, 144, 288, 2016, 8640, 105120)]
    return b.select("*", *cols)


def ref_collected_metrics(spark, sf_dir):
    """Reference shape: collect (target, prediction, score) rows to the
    driver and compute accuracy/precision/recall and AUC there."""
    from tickflow.plans.evaluation import scored_rows
    rows = scored_rows(spark, sf_dir).select("target", "prediction", "score").collect()
    y = [r[0] for r in rows]
    p = [r[1] for r in rows]
    s = [r[2] for r in rows]
    tp = sum(1 for a, b in zip(y, p) if a == 1 and b == 1)
    fp = sum(1 for a, b in zip(y, p) if a == 0 and b == 1)
    fn = sum(1 for a, b in zip(y, p) if a == 1 and b == 0)
    _ = (tp / max(tp + fp, 1), tp / max(tp + fn, 1))
    order = sorted(range(len(s)), key=lambda i: s[i])
    ranks, i = [0.0] * len(s), 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and s[order[j + 1]] == s[order[i]]:
            j += 1
        for k in range(i, j + 1):
            ranks[order[k]] = (i + j) / 2 + 1
        i = j + 1
    return sum(r for r, t in zip(ranks, y) if t == 1)


def main() -> None:
    from tickflow.plans import QUERIES
    from tickflow.session import build_session

    spark = build_session(f"local[{CPUS}]", app="tickflow-bench",
                          shuffle_partitions=max(2 * CPUS, 4),
                          extra={"spark.driver.memory": "16g"})
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    out: dict[str, float] = {}
    for name in HEADLINE:
        fn = QUERIES[name].fn
        out[name] = _time(lambda fn=fn: _run(fn(spark, SF_DIR)), REPEAT, name)
        print(f"{name}: {out[name]}s", file=sys.stderr)

    # Large-series plans forced on (not in the total): quantile-slice index
    # and chunk-with-halo windows, as used when a series exceeds one task.
    extra: dict[str, float] = {}
    for name in ("pct_change_global_halo", "rolling_24h_range_sliced", "auc_roc_sliced"):
        fn = QUERIES[name].fn
        extra[name] = _time(lambda fn=fn: _run(fn(spark, SF_DIR)), REPEAT, name)
    # Model and stream queries, one warm run each.
    for name in ("gbt_predictions", "cv_best", "stream_score", "stream_bars", "keyed_outer_join",
                 "csv_features"):
        fn = QUERIES[name].fn
        extra[name] = _time(lambda fn=fn: _run(fn(spark, SF_DIR)), 1, name)

    base: dict[str, float] = {}
    for name, fn in [("ref_chained_lags", ref_chained_lags),
                     ("ref_nested_loop_rolling", ref_nested_loop_rolling),
                     ("ref_nested_loop_rolling_nokey", ref_nested_loop_rolling_nokey),
                     ("ref_global_window_lags", ref_global_window_lags)]:
        base[name] = _time(lambda fn=fn: _run(fn(spark, SF_DIR)), REPEAT, name)
        print(f"{name}: {base[name]}s", file=sys.stderr)
    from tickflow.operators.rolling import rolling_join
    from tickflow.plans.series import _bars
    out_single = _time(lambda: _run(rolling_join(_bars(spark, SF_DIR, single=True), "volume",
                                                 "24 hours", out="v24")), REPEAT, "rolling_single")
    extra["rolling_24h_join_single_series"] = out_single
    base["ref_collected_metrics"] = _time(lambda: ref_collected_metrics(spark, SF_DIR), REPEAT,
                                          "ref_collected_metrics")

    # Stream throughput: parse every event as a tick message, availableNow.
    rate = None
    try:
        n = QUERIES["stream_parse"].fn(spark, SF_DIR).count()
        out["stream_parse"] = _time(lambda: QUERIES["stream_parse"].fn(spark, SF_DIR).count(),
                                    REPEAT, "stream_parse")
        rate = round(n / out["stream_parse"], 1)
    except Exception as e:  # noqa: BLE001
        ERRORS["stream_parse"] = f"{type(e).__name__}: {str(e)[:300]}"

    # Like for like: the reference's rolling join has one series and no key.
    pairs = {"label_up": "ref_chained_lags",
             "rolling_24h_join_single_series": "ref_nested_loop_rolling_nokey",
             "pct_change_global": "ref_global_window_lags", "auc_roc": "ref_collected_metrics"}
    ours = out | extra
    speedup = {k: round(base[v] / ours[k], 3) for k, v in pairs.items()
               if ours.get(k) and base.get(v)}
    total = round(sum(v for v in out.values() if v is not None), 4)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": out,
        "sf": sf, "cpus": CPUS, "repeat": REPEAT, "reference_shaped": base,
        "speedup_vs_reference_shape": speedup, "stream_rows_per_sec": rate,
        "large_series_plans": extra,
        "errors": ERRORS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
