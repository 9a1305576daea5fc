"""Tick payload parsing (PRJ-1..6, FLT-8, SCL-16, Q10, Q16, Q18).

Every function is a ``DataFrame -> DataFrame`` transform that runs unchanged
on a batch frame or a streaming frame (files, Kafka)."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, TimestampType

from tickflow import schemas as S
from tickflow.functions.jsoncols import binary_to_text, encode, parse
from tickflow.operators.names import private

PERCENT_FIELDS = [f for f in S.QUOTE_NUMERIC_FIELDS if f.startswith("percent_change_")]


def as_text(df: DataFrame, value: str = "value", key: str | None = None,
            out: str = "json_string") -> DataFrame:
    """PRJ-1: binary message value (and optionally key) -> text."""
    cols = [binary_to_text(F.col(value)).alias(out)]
    if key:
        cols.insert(0, binary_to_text(F.col(key)).alias(key))
    keep = [c for c in df.columns if c not in (value, key)]
    return df.select(*keep, *cols)


def parse_ticks(df: DataFrame, text: str = "json_string", schema=S.TICK,
                fields: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-2 + PRJ-3: parse with a fixed schema and lift the fields.

    All 17 fields are kept by default (the reference's projection dropped the
    symbol, volume and event time it had parsed, Q15). A ``valid`` column
    marks rows with both an event time and a price: the text ``null`` and
    malformed text parse to a struct of nulls, not a null struct (Q16)."""
    names = list(fields) if fields else [f.name for f in schema.fields]
    p = df.select(*keep, F.col(text), parse(F.col(text), schema).alias("_j"))
    out = p.select(*keep, F.col(text), *[F.col(f"_j.{n}").alias(n) for n in names])
    checks = [F.col(c).isNotNull() for c in ("timestamp", "price") if c in names]
    valid = checks[0] if checks else F.lit(True)
    for c in checks[1:]:
        valid = valid & c
    return out.withColumn("valid", valid)


# A number of the feed as one type: 19 integer digits and 9 places.
WIDE = "decimal(28,9)"


def parse_ticks_any(df: DataFrame, text: str = "json_string", fields: Sequence[str] = S.TICK.names,
                    keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-2 under type drift (Q16, Q17): the text is parsed once as VARIANT, and
    each field is read by what it holds. Integer fields of the schema become
    ``WIDE``, so a whole number, a fraction and a number in quotes are all kept;
    double fields take the same three. Whatever cannot be read (an object, a
    word, a number out of range) is null, and so are all fields of malformed text
    and of the text ``null``. ``valid`` as in ``parse_ticks``."""
    v = private([*keep, *fields, text], "_v")
    d = df.select(*keep, text, F.try_parse_json(F.col(text)).alias(v))

    def lift(name):
        path, kind = f"$.{name}", S.TICK[name].dataType
        if isinstance(kind, (LongType, IntegerType)):
            return F.try_variant_get(F.col(v), path, WIDE)
        if isinstance(kind, TimestampType):
            return F.try_to_timestamp(F.try_variant_get(F.col(v), path, "string"))
        return F.try_variant_get(F.col(v), path, kind.simpleString())

    out = d.select(*keep, text, *[lift(n).alias(n) for n in fields])
    needed = [F.col(c).isNotNull() for c in ("timestamp", "price") if c in fields]
    return out.withColumn("valid", functools.reduce(lambda a, b: a & b, needed, F.lit(True)))


def split_valid(parsed: DataFrame, text: str = "json_string"):
    """Q16: (good ticks, quarantine rows with the raw text and a reason)."""
    reason = (F.when(F.col("timestamp").isNull(), F.lit("no_timestamp"))
              .when(F.col("price").isNull(), F.lit("no_price")))
    good = parsed.filter(F.col("valid")).drop("valid")
    bad = parsed.filter(~F.col("valid")).withColumn("reason", reason)
    return good, bad


def percent_to_fraction(df: DataFrame, cols: Sequence[str] = tuple(PERCENT_FIELDS)) -> DataFrame:
    """Q10: feed values arrive in percent; the model is trained on fractions."""
    return df.withColumns({c: F.col(c) / F.lit(100.0) for c in cols if c in df.columns})


def flatten_ticker(df: DataFrame, text: str = "json_string", keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-6: raw ticker document -> flat tick: the USD quote's fields,
    symbol, beta_value, and last_updated as the event time; the all-time-high
    fields are dropped. Malformed documents give null fields."""
    d = df.select(*keep, parse(F.col(text), S.TICKER_DOC).alias("_d"))
    quote = [F.col(f"_d.quotes.USD.{n}").alias(n) for n in S.QUOTE_NUMERIC_FIELDS]
    return d.select(*keep, *quote, F.col("_d.symbol").alias("symbol"),
                    F.col("_d.beta_value").alias("beta_value"),
                    F.try_to_timestamp(F.col("_d.last_updated")).alias("timestamp"))


def explode_payload(df: DataFrame, text: str = "json_string", keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-4 + FLT-8 + PRJ-5: ``{"data": [...]}`` -> one row per element,
    flattened with aliases (``schemas.ARRAY_SYMBOL_FIELD`` is the symbol)."""
    d = df.select(*keep, parse(F.col(text), S.ARRAY_PAYLOAD).alias("value")).select(
        *keep, "value.*")
    e = d.select(*keep, F.explode("data").alias("data"))
    return e.selectExpr(*keep, *[f"data.{f.name} as {f.name}" for f in S.ARRAY_ITEM.fields])


def encode_rows(df: DataFrame, cols: Sequence[str], out: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """SCL-16 / SNK-3 payload: selected columns -> one JSON text per row."""
    return df.select(*keep, encode(*cols).alias(out))
