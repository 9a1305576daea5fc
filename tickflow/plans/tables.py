"""Queries over orders / lineitem / events rows: splits, counts, columns,
dedup, time conversions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow import schemas as SC
from tickflow.functions import temporal as T
from tickflow.operators import columns as C
from tickflow.operators import split as S
from tickflow.operators.lags import REFERENCE_HORIZONS
from tickflow.operators.labels import feature_table
from tickflow.plans.registry import query
from tickflow.plans.series import _bars
from tickflow.session import stage
from tickflow.sources.tables import read_table

TEST_YEAR = 2000   # last complete year of the orders table
MIN_YEAR = 1999


@query("split_year", ("FLT-1", "SCL-4"), oracle=f"""
SELECT o_orderkey, o_orderdate,
       CASE WHEN year(o_orderdate) = {TEST_YEAR} THEN 'test' ELSE 'train' END AS split
FROM orders""")
def split_year(spark, sf_dir):
    """Out-of-time split: rows of the test year vs every other year."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return S.label_by_year(o, "o_orderdate", TEST_YEAR)


@query("year_counts", ("AGG-5", "SCL-4", "SRT-2", "Q24"), oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n
FROM orders GROUP BY 1 ORDER BY n DESC""")
def year_counts(spark, sf_dir):
    """Rows per year, most frequent first."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    return S.counts_by(o, T.year_of(F.col("o_orderdate")).alias("year")).orderBy(F.desc("n"))


@query("filter_year_ge", ("FLT-2",), oracle=f"""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE year(o_orderdate) >= {MIN_YEAR}""")
def filter_year_ge(spark, sf_dir):
    """Orders from a year on (range predicate, pushed into the scan)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate",
                                             "o_totalprice"])
    return o.filter(S.year_at_least(F.col("o_orderdate"), MIN_YEAR))


_DEDUP_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_rows", ("FLT-4", "PRJ-9"),
       oracle=f"SELECT DISTINCT {', '.join(_DEDUP_COLS)} FROM lineitem")
def dedup_rows(spark, sf_dir):
    """Distinct rows over nine selected lineitem columns."""
    return C.dedup(read_table(spark, sf_dir, "lineitem", _DEDUP_COLS))


@query("rename_subset", ("PRJ-7", "PRJ-8", "PRJ-9"), oracle="""
SELECT o_orderkey AS id, o_orderdate AS date, o_totalprice AS close FROM orders""")
def rename_subset(spark, sf_dir):
    """Column subset, renamed; the scan reads only those columns."""
    o = read_table(spark, sf_dir, "orders")
    o = C.drop_columns(o, "o_orderstatus", "o_orderpriority", "o_custkey")
    return C.rename(o, {"o_orderkey": "id", "o_orderdate": "date", "o_totalprice": "close"})


@query("regex_columns", ("PRJ-10",), oracle="""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax FROM lineitem""")
def regex_columns(spark, sf_dir):
    """Key columns plus every column whose name matches 'price|discount|tax'."""
    li = read_table(spark, sf_dir, "lineitem")
    return C.select_matching(li, r"price|discount|tax", keep=["l_orderkey", "l_linenumber"])


_MINUTE_COLS = [f.name for f in SC.MINUTE_CSV.fields]


@query("normalise_minutes", ("PRJ-8", "PRJ-9", "PRJ-11", "SCL-2", "FLT-4", "FLT-2"),
       oracle=f"""
SELECT DISTINCT CAST(floor(epoch(ts)) AS BIGINT) AS unix, ts AS date,
       '{SC.MINUTE_SYMBOL}' AS symbol, value AS open, value AS high, value AS low,
       value AS close, value AS "{SC.VOLUME_BASE_COL}", value AS "{SC.VOLUME_QUOTE_COL}"
FROM events WHERE year(ts) >= 2024""")
def normalise_minutes(spark, sf_dir):
    """Raw minute rows -> the per-year file layout: renamed volumes, unix
    seconds, literal symbol, nine columns, duplicates dropped, from 2024 on.
    (Raw rows are events in the raw minute schema: a rename only.)"""
    ev = read_table(spark, sf_dir, "events", ["ts", "value"])
    raw = ev.select(F.col("ts").alias("timestamp"), *[F.col("value").alias(c) for c in (
        "open", "high", "low", "close", "volume", "quote_asset_volume")])
    d = C.rename(raw, {"timestamp": "date", "volume": SC.VOLUME_BASE_COL,
                       "quote_asset_volume": SC.VOLUME_QUOTE_COL})
    d = d.withColumn("unix", T.ts_to_seconds(F.col("date")))
    d = C.with_literal(d, "symbol", SC.MINUTE_SYMBOL)
    d = C.dedup(C.subset(d, _MINUTE_COLS))
    return d.filter(S.year_at_least(F.col("date"), 2024))


@query("unix_roundtrip", ("SCL-1", "SCL-2", "SCL-3"), oracle="""
SELECT event_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS unix,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS from_unix,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM events""")
def unix_roundtrip(spark, sf_dir):
    """Timestamp -> unix seconds -> timestamp, and timestamp -> text -> timestamp."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    unix = T.ts_to_seconds(F.col("ts"))
    text = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    return ev.select("event_id", "ts", unix.alias("unix"),
                     T.seconds_to_ts(unix).alias("from_unix"),
                     T.parse_ts(text, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


# --------------------------------------------------------------------------- ML splits
def _labelled(spark, sf_dir):
    return feature_table(_bars(spark, sf_dir), "5 minutes", REFERENCE_HORIZONS)


def _split_key():
    return T.ts_to_seconds(F.col("timestamp"))


def _hash_sql(col="CAST(floor(epoch(timestamp)) AS BIGINT)"):
    return f"(CAST('0x' || substr(md5(CAST({col} AS VARCHAR)), 1, 8) AS BIGINT) % 5)"


def _labelled_sql():
    from tickflow.plans.series import _label_oracle
    return _label_oracle("5 minutes", REFERENCE_HORIZONS, 3, "15m")


@query("split_hash_counts", ("ML-1", "AGG-6"), oracle=f"""
SELECT {_hash_sql()} = 0 AS isVal, COUNT(*) AS n FROM ({_labelled_sql()}) l GROUP BY 1""")
def split_hash_counts(spark, sf_dir):
    """Train/validation sizes of the stable 80/20 hash split."""
    f = S.with_validation_flag(_labelled(spark, sf_dir), _split_key())
    return S.counts_by(f, "isVal")


@query("train_val_union", ("ML-1", "SET-1", "PRJ-11"), oracle=f"""
SELECT *, {_hash_sql()} = 0 AS isVal FROM ({_labelled_sql()}) l""")
def train_val_union(spark, sf_dir):
    """Train and validation frames flagged with a literal and unioned back.
    The feature table feeds both frames, so it is staged once (checkpoint)."""
    train, val = S.split_hash(stage(_labelled(spark, sf_dir)), _split_key())
    return S.union_flagged(train, val)
