"""JSON scalars (SCL-16, PRJ-1, PRJ-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def binary_to_text(value: Column) -> Column:
    """PRJ-1: Kafka bytes -> UTF-8 text."""
    return value.cast("string")


# Microsecond ISO-8601 layouts, so timestamps survive a JSON
# round trip (Spark's default layout keeps milliseconds only).
TS_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def parse(text: Column, schema: StructType) -> Column:
    """PRJ-2: permissive parse. Malformed text and the literal ``null`` give a
    struct of nulls (never a null struct), so validity is judged on fields."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def parse_exact(text: Column, schema: StructType) -> Column:
    """Parse text written by ``encode`` (microsecond timestamps)."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE", **TS_OPTIONS})


def encode(*cols) -> Column:
    """SCL-16: row -> JSON text."""
    return F.to_json(F.struct(*cols), TS_OPTIONS)
