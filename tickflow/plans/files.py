"""File round-trip queries (write with the sink, read with the source)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow import schemas as SC
from tickflow.operators import bars as B
from tickflow.operators import lags as G
from tickflow.plans import oracle_sql as O
from tickflow.plans.registry import query
from tickflow.plans.series import REF
from tickflow.plans.signals import _PREDS_SQL, rule_predictions
from tickflow.session import scratch_path
from tickflow.sources import files as FS
from tickflow.sources.tables import read_table


@query("csv_roundtrip_years", ("SNK-4", "SRC-1"), oracle="""
SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders""")
def csv_roundtrip_years(spark, sf_dir):
    """Orders written as one CSV folder per year, read back through the
    year-file scan (explicit schema, year from the folder names)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    path = FS.write_year_csvs(o, "o_orderdate", scratch_path(spark, "orders_csv"))
    back = FS.read_year_csvs(spark, path, StructType(o.schema.fields))
    return back.select("o_orderkey", "o_orderdate", "o_totalprice", "year")


@query("predictions_csv", ("SRC-3", "SRT-2"), oracle=f"""
SELECT label, prob, price, time FROM ({_PREDS_SQL}) p ORDER BY time""")
def predictions_csv(spark, sf_dir):
    """Prediction rows stored in the indexed CSV layout and read back
    renamed and sorted by time."""
    preds = rule_predictions(spark, sf_dir).select("label", "prob", "price", "time")
    path = FS.write_predictions_csv(preds, scratch_path(spark, "preds_csv"))
    return FS.read_predictions_csv(spark, path)


@query("minute_csv_roundtrip", ("SRC-2", "PRJ-8", "PRJ-9", "PRJ-11", "SCL-2", "FLT-4", "SNK-4",
                                "SRC-1"), oracle=f"""
SELECT DISTINCT CAST(floor(epoch(ts)) AS BIGINT) AS unix, ts AS date,
       '{SC.MINUTE_SYMBOL}' AS symbol, value AS open, value AS high, value AS low,
       value AS close, value AS "{SC.VOLUME_BASE_COL}", value AS "{SC.VOLUME_QUOTE_COL}",
       CAST(year(ts) AS INTEGER) AS year
FROM events""")
def minute_csv_roundtrip(spark, sf_dir):
    """The historical-file preparation end to end: raw minute rows land as a
    CSV (events in the raw minute layout: a rename only), are read back with
    the raw schema, normalised (renamed volumes, unix seconds, literal
    symbol, nine columns, duplicates dropped), written one CSV folder per
    year and read back through the year-file scan."""
    return minute_rows(spark, sf_dir)


def minute_rows(spark, sf_dir):
    from tickflow.operators import columns as C
    from tickflow.functions import temporal as T
    from tickflow import schemas as S
    ev = read_table(spark, sf_dir, "events", ["ts", "value"])
    raw = ev.select(F.col("ts").alias("timestamp"), *[
        F.col("value").alias(c) for c in ("open", "high", "low", "close", "volume",
                                          "quote_asset_volume")])
    raw_path = FS.write_csv(raw, scratch_path(spark, "raw_minutes_csv"))
    r = FS.read_raw_csv(spark, raw_path, S.RAW_MINUTE_CSV)
    d = C.rename(r, {"timestamp": "date", "volume": S.VOLUME_BASE_COL,
                     "quote_asset_volume": S.VOLUME_QUOTE_COL})
    d = d.withColumn("unix", T.ts_to_seconds(F.col("date")))
    d = C.dedup(C.subset(C.with_literal(d, "symbol", S.MINUTE_SYMBOL),
                         [f.name for f in S.MINUTE_CSV.fields]))
    year_path = FS.write_year_csvs(d, "date", scratch_path(spark, "minutes_by_year"))
    return FS.read_year_csvs(spark, year_path, S.MINUTE_CSV)


_CSV_BARS = f"""SELECT '{SC.MINUTE_SYMBOL}' AS symbol, time_bucket(INTERVAL '5 minutes', sec,
         TIMESTAMP '1970-01-01') + INTERVAL '5 minutes' AS timestamp,
       arg_max(value, (sec, value)) AS price,
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS volume
FROM (SELECT DISTINCT ts, value, date_trunc('second', ts) AS sec FROM events) GROUP BY 1, 2"""


@query("csv_features", ("SRC-1", "SCL-1", "AGG-1", "WIN-1", "SCL-9"), oracle=f"""
SELECT * EXCLUDE (wk) FROM ({O.week_lags(_CSV_BARS, REF, '5 minutes')}) x""")
def csv_features(spark, sf_dir):
    """The batch path from year files: minute rows read from CSV, unix seconds
    to timestamps, 5-minute bars of close and quote volume, lagged changes."""
    from tickflow.functions.temporal import seconds_to_ts
    rows = minute_rows(spark, sf_dir).withColumns({
        "ts": seconds_to_ts(F.col("unix")).cast("timestamp_ntz")})
    b = B.bars(rows, "5 minutes", price="close", volume=SC.VOLUME_QUOTE_COL, tiebreak="close")
    return G.pct_change_features(b, REF, "5 minutes")


@query("parquet_year_rewrite", ("SNK-4", "SNK-2", "FLT-1"), oracle="""
SELECT o_orderkey, o_orderdate, CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice * 2
       ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders""")
def parquet_year_rewrite(spark, sf_dir):
    """Orders written as one Parquet folder per year, then the rows of 1995
    written again with other prices: that folder alone is replaced."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    path = FS.write_year_parquet(o, "o_orderdate", scratch_path(spark, "orders_years"))
    again = o.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    FS.write_year_parquet(again, "o_orderdate", path, years=[1995])
    return FS.read_year_parquet(spark, path, StructType(o.schema.fields))
