import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tickflow import schemas as S
from tickflow.functions import temporal as T
from tickflow.plans.models import training_sets
from tickflow.plans.series import _bars
from tickflow.operators.labels import feature_table
from tickflow.session import configure, scratch_path
from tickflow.sources import files as FS


def test_year_files_by_name(spark):
    """Flat layout: only names holding four consecutive digits are read."""
    root = scratch_path(spark, "year_files")
    rows = {"BTC-2022min.csv": 2022, "BTC-2023min.csv": 2023, "notes.csv": None}
    import os
    os.makedirs(root, exist_ok=True)
    header = ",".join(f.name for f in S.MINUTE_CSV.fields)
    for name, year in rows.items():
        y = year or 1999
        with open(os.path.join(root, name), "w") as fh:
            fh.write(header + "\n")
            fh.write(f"{1000 + y},{y}-03-01 10:00:00,BTC/USD,1,2,0.5,1.5,10,{y}.5\n")
    df = FS.read_year_csvs(spark, root)
    got = sorted((r["unix"], r["Volume USD"], r["date"]) for r in df.collect())
    assert got == [(3022, 2022.5, dt.datetime(2022, 3, 1, 10)),
                   (3023, 2023.5, dt.datetime(2023, 3, 1, 10))]


def test_session_is_pinned_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    # 2024-03-10 07:30 UTC lies in New York's skipped DST hour; seconds map exactly.
    d = spark.createDataFrame([(1710055800,)], "u long")
    assert d.select(T.seconds_to_ts(F.col("u"))).first()[0] == dt.datetime(2024, 3, 10, 7, 30)


@pytest.mark.parametrize("parts", [1, 13])
def test_feature_table_partition_invariant(spark, parts):
    base = feature_table(_bars(spark, SF01), "5 minutes")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        other = feature_table(_bars(spark, SF01), "5 minutes")
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_train_val_test_cover_features_disjointly(spark):
    train, test = training_sets(spark, SF01)
    allf = feature_table(_bars(spark, SF01), "5 minutes")
    assert train.count() + test.count() == allf.count()
    keys = ["symbol", "timestamp"]
    assert train.select(keys).intersect(test.select(keys)).count() == 0
    assert train.filter("isVal").count() > 0 and train.filter("not isVal").count() > 0


def _formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_time_filters_reach_the_parquet_scan(spark):
    from __spark_entry__ import queries
    plan = _formatted(spark, queries()["date_range"](spark, SF01))
    assert "GreaterThanOrEqual(ts,2024-01-06T01:00)" in plan
    plan = _formatted(spark, queries()["filter_year_ge"](spark, SF01))
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01T00:00)" in plan
    schema = [l for l in plan.splitlines() if "ReadSchema" in l][0]
    assert "o_orderstatus" not in schema and "o_orderpriority" not in schema


def test_year_folders_are_pruned(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderdate")
    path = FS.write_year_csvs(o, "o_orderdate", scratch_path(spark, "pruned"))
    r = FS.read_year_csvs(spark, path, o.schema).filter(F.col("year") == 1999)
    assert "PartitionFilters: [isnotnull(year" in _formatted(spark, r)
    assert r.count() == o.filter(F.year("o_orderdate") == 1999).count()


def test_one_year_is_rewritten_alone(spark):
    """The files of other years stay as they are, and a year filter opens one folder."""
    import glob
    import os

    from pyspark.sql import functions as F

    from tickflow.session import scratch_path
    from tickflow.sources import files as FS
    rows = [(i, f"{y}-03-0{1 + i % 9} 10:00:00") for i, y in enumerate([2021, 2022, 2022, 2023])]
    df = spark.createDataFrame(rows + [(9, None)], "k long, t string").select(
        "k", F.col("t").cast("timestamp_ntz").alias("ts"))
    path = FS.write_year_parquet(df, "ts", scratch_path(spark, "years"))
    local = path.removeprefix("file:")
    files = lambda y: {f: os.stat(f).st_mtime_ns
                       for f in glob.glob(f"{local}/year={y}/*.parquet")}
    before = {y: files(y) for y in (2021, 2022, 2023, "__HIVE_DEFAULT_PARTITION__")}
    assert all(before.values())
    FS.write_year_parquet(df.withColumn("k", F.col("k") + 100), "ts", path, years=[2022])
    for y, was in before.items():
        assert (files(y) == was) == (y != 2022)
    back = FS.read_year_parquet(spark, path, df.schema)
    assert sorted((r["k"], r["year"]) for r in back.collect() if r["year"]) == [
        (0, 2021), (3, 2023), (101, 2022), (102, 2022)]
    assert back.filter("year IS NULL").collect()[0]["k"] == 9
    one = FS.read_year_parquet(spark, path, df.schema, years=[2023])
    assert one.inputFiles() and [r["k"] for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(year" in plan
