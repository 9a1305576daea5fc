"""Reading the driver's parquet tables (column pruning happens in the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
