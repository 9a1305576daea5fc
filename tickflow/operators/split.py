"""Row splits and set sizes (FLT-1, FLT-2, ML-1, AGG-5, AGG-6, SET-1).

The reference's ``randomSplit`` depends on partitioning and row order; here a
row's side is a hash of a stable integer key, identical on every run, every
partitioning and in SQL engines that have MD5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_start(year: int) -> Column:
    return F.make_timestamp_ntz(F.lit(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def in_year(ts: Column, year: int) -> Column:
    """``year(ts) == y`` as a half-open range, so the scan can prune on it."""
    return (ts >= year_start(year)) & (ts < year_start(year + 1))


def year_at_least(ts: Column, year: int) -> Column:
    """FLT-2: ``year(ts) >= y`` as a range predicate."""
    return ts >= year_start(year)


def split_by_year(df: DataFrame, ts: str, test_year: int = 2023, *,
                  train_before: bool = False) -> tuple[DataFrame, DataFrame]:
    """FLT-1: test = rows of ``test_year``; train = every other year (the
    reference), or only earlier years with ``train_before=True`` (Q8)."""
    c = F.col(ts)
    test = df.filter(in_year(c, test_year))
    train = df.filter(c < year_start(test_year)) if train_before else df.filter(
        ~in_year(c, test_year) | c.isNull())
    return train, test


def label_by_year(df: DataFrame, ts: str, test_year: int = 2023, out: str = "split") -> DataFrame:
    """FLT-1 as a column: 'test' or 'train'."""
    return df.withColumn(out, F.when(in_year(F.col(ts), test_year), F.lit("test"))
                         .otherwise(F.lit("train")))


def hash_bucket(key: Column, buckets: int = 5) -> Column:
    """Q9: stable bucket 0..buckets-1 from the first 32 bits of md5(key)."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % F.lit(buckets)


def with_validation_flag(df: DataFrame, key: Column, val_fraction_buckets: int = 1,
                         buckets: int = 5, out: str = "isVal") -> DataFrame:
    """ML-1: the 80/20 train/validation split as a boolean column (bucket 0
    of 5 = validation)."""
    return df.withColumn(out, hash_bucket(key, buckets) < F.lit(val_fraction_buckets))


def split_hash(df: DataFrame, key: Column, buckets: int = 5) -> tuple[DataFrame, DataFrame]:
    """ML-1 as two frames (train, validation)."""
    b = hash_bucket(key, buckets)
    return df.filter(b != 0), df.filter(b == 0)


def union_flagged(train: DataFrame, val: DataFrame, out: str = "isVal") -> DataFrame:
    """SET-1: train and validation back in one frame with a literal flag."""
    return (train.withColumn(out, F.lit(False))
            .unionByName(val.withColumn(out, F.lit(True))))


def counts_by(df: DataFrame, col: Column | str, name: str = "n") -> DataFrame:
    """AGG-5 / AGG-6: rows per value (one partial+final aggregate)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
