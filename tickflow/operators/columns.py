"""Column shaping, dedup, ordering and appends (PRJ-7..11, FLT-4, SRT-1..3, SET-2)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """PRJ-7."""
    return df.drop(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-8."""
    return df.withColumnsRenamed(mapping)


def subset(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-9: column subset in the given order (pruned at the scan)."""
    return df.select(*names)


def matching(df: DataFrame, pattern: str) -> list[str]:
    """Names of columns whose name matches ``pattern`` anywhere."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_matching(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-10: ``keep`` columns plus every column whose name matches."""
    return df.select(*keep, *[c for c in matching(df, pattern) if c not in keep])


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """PRJ-11."""
    return df.withColumn(name, F.lit(value))


def dedup(df: DataFrame, subset_cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-4: duplicates removed by a partial + final hash aggregate, so a
    heavily repeated row collapses map-side before the shuffle."""
    return df.dropDuplicates(list(subset_cols)) if subset_cols else df.distinct()


def first_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """SRT-1 + SRT-3: first ``n`` rows by ``order`` (top-k per task, then a
    merge of k rows per task: no full sort)."""
    return df.orderBy(*order).limit(n)


def append(history: DataFrame, new: DataFrame) -> DataFrame:
    """SET-2: append new records to history (by column name; Q23: rows are
    appended, not columns)."""
    return history.unionByName(new, allowMissingColumns=True)
