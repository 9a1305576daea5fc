"""Registry of named queries: each is a Spark plan over the driver tables plus,
where SQL can express it, an independent DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    operators: tuple[str, ...]
    oracle: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def query(name: str, operators: tuple[str, ...] | str, oracle: str | None = None):
    ops = (operators,) if isinstance(operators, str) else tuple(operators)

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, ops, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco
