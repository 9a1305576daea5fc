"""File sources and sinks (SRC-1, SRC-2, SRC-3, SNK-4). Schemas are always
explicit: nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tickflow import schemas as S

# Fixed value: a year-file is any entry whose name holds four consecutive digits.
# So is a year= folder: rows of years before 1000 or without a time are there.
YEAR_GLOB = "{*[0-9][0-9][0-9][0-9]*,year=*}"
# Microsecond timestamp layouts for writing (the CSV writer's
# defaults keep milliseconds only). Reads keep Spark's lenient default
# parser, which accepts these as well as plain 'yyyy-MM-dd HH:mm:ss' text.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# A file whose header differs from the columns asked for fails the read.
CSV_READ_OPTIONS = {"header": "true", "enforceSchema": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def read_year_csvs(spark: SparkSession, directory: str, schema: StructType = S.MINUTE_CSV,
                   header: bool = True) -> DataFrame:
    """SRC-1: every CSV in ``directory`` whose name contains a year, read as
    one table. Works for flat files (``PAIR-2022min.csv``) and for the
    ``year=2022/`` folders ``write_year_csvs`` produces (the year then comes
    back as a partition column)."""
    base = directory.rstrip("/")
    reader = spark.read.options(**CSV_READ_OPTIONS).option("header", header).option(
        "basePath", base)
    return _by_name(reader, f"{base}/{YEAR_GLOB}", schema, header)


def _by_name(reader, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """Columns by header name, whatever their order in the file; the first
    file's header decides, and files that deviate from it fail. Names are
    compared as Spark does, without case."""
    if header:
        names = {f.name.lower(): f for f in schema}
        found = [c.lower() for c in reader.csv(path).columns]
        order = [names[c] for c in found if c in names]
        if len(order) != len(schema):
            raise ValueError(f"{path}: the header lacks {sorted(set(names) - set(found))}")
        asked = StructType([names[c] if c in names else StructField(c, StringType())
                            for c in found if c in names or c != "year"])
        df = reader.schema(asked).csv(path)
        return df.select(*[f.name for f in schema], *(
            ["year"] if "year" in df.columns and "year" not in names else []))
    return reader.schema(schema).csv(path)


def read_raw_csv(spark: SparkSession, path: str, schema: StructType = S.RAW_MINUTE_CSV) -> DataFrame:
    """SRC-2: the raw historical minute file."""
    return _by_name(spark.read.options(**CSV_READ_OPTIONS), path, schema)


def write_year_csvs(df: DataFrame, ts: str, path: str, mode: str = "overwrite") -> str:
    """SNK-4: one header CSV folder per year. The writer sorts rows by year
    inside each task, so no extra shuffle is added."""
    (df.withColumn("year", F.year(F.col(ts))).write.mode(mode).partitionBy("year")
     .options(**CSV_WRITE_OPTIONS).csv(path))
    return path


def write_year_parquet(df: DataFrame, ts: str, path: str, years=None) -> str:
    """SNK-4 as Parquet, one folder per year. Only the folders of years that
    occur in ``df`` are replaced (dynamic partition overwrite); files of other
    years are not touched, and a failed write leaves all as it was. ``years``
    keeps rows of those years alone. A row without a time is in no year: it goes
    to the folder of nulls. One shuffle brings a year's rows together; AQE splits
    large years and joins small ones, so neither tasks nor files grow with a year."""
    year = "year"
    if year in df.columns:
        raise ValueError("the table has a column 'year'; the folders are named so")
    d = df.withColumn(year, F.year(F.col(ts)))
    if years is not None:
        d = d.filter(F.col(year).isin(*years))
    (d.hint("rebalance", F.col(year)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path))
    return path


def read_year_parquet(spark: SparkSession, path: str, schema: StructType,
                      years=None) -> DataFrame:
    """The folders of ``write_year_parquet``; a filter on ``year`` opens only
    the folders it names."""
    df = spark.read.schema(StructType([*schema.fields, StructField("year", IntegerType())])
                           ).parquet(path)
    return df if years is None else df.filter(F.col("year").isin(*years))


PREDICTIONS_FILE = StructType([StructField("index", LongType(), True)] + [
    StructField(str(i), f.dataType, True) for i, f in enumerate(S.PREDICTIONS_CSV.fields)])


def write_predictions_csv(preds: DataFrame, path: str) -> str:
    """Predictions in the stored layout: an index column, then columns named
    0..3 (label, prob, price, time)."""
    cols = [F.col(f.name).alias(str(i)) for i, f in enumerate(S.PREDICTIONS_CSV.fields)]
    (preds.select(F.monotonically_increasing_id().alias("index"), *cols)
     .write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path))
    return path


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: index dropped, columns named label, prob, price, time, sorted
    by time."""
    df = spark.read.schema(PREDICTIONS_FILE).options(**CSV_READ_OPTIONS).csv(path)
    named = df.select(*[F.col(str(i)).alias(f.name) for i, f in enumerate(S.PREDICTIONS_CSV.fields)])
    return named.orderBy("time")
