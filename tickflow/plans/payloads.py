"""JSON payload queries: parse, quarantine, round-trip, ticker flatten, explode."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow import schemas as SC
from tickflow.functions.jsoncols import parse_exact
from tickflow.plans.registry import query
from tickflow.sources import events as E
from tickflow.sources import ticks as K
from tickflow.sources.tables import read_table

_EV = ["event_id", "ts", "user_id", "event_type", "value"]


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", _EV)


@query("json_fields", ("PRJ-2", "PRJ-3", "Q15", "Q16"), oracle="""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
       CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE user_id END AS market_cap,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS symbol,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE ts END AS timestamp,
       event_type NOT IN ('error', 'signup') AS valid
FROM events""")
def json_fields(spark, sf_dir):
    """Tick JSON text -> fixed-schema struct -> fields, with a validity flag."""
    p = K.parse_ticks(E.tick_documents(_events(spark, sf_dir)), keep=["event_id"])
    return p.select("event_id", "price", "market_cap", "symbol",
                    F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "valid")


@query("json_drifting_types", ("PRJ-2", "PRJ-3", "Q16", "Q17"), oracle="""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
       CASE WHEN event_type IN ('error', 'view') THEN NULL
            WHEN event_type = 'click' THEN CAST(user_id + 0.25 AS DECIMAL(28,9))
            ELSE CAST(user_id AS DECIMAL(28,9)) END AS market_cap,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS symbol,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS timestamp,
       event_type <> 'error' AS valid
FROM events""")
def json_drifting_types(spark, sf_dir):
    """Tick messages whose number types change from row to row, read as
    VARIANT: fractions and quoted numbers are widened, not nulled."""
    p = K.parse_ticks_any(E.drifting_documents(_events(spark, sf_dir)), keep=["event_id"])
    return p.select("event_id", "price", "market_cap", "symbol",
                    F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "valid")


@query("json_quarantine", ("Q16",), oracle="""
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'no_timestamp' END AS reason
FROM events WHERE event_type IN ('error', 'signup')""")
def json_quarantine(spark, sf_dir):
    """Rows that fail validation, with the reason (raw text kept in the
    library output for a quarantine sink)."""
    p = K.parse_ticks(E.tick_documents(_events(spark, sf_dir)), keep=["event_id"])
    _, bad = K.split_valid(p)
    return bad.select("event_id", "reason")


@query("json_roundtrip", ("SCL-16", "PRJ-4"), oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events""")
def json_roundtrip(spark, sf_dir):
    """Rows -> JSON text -> parsed back with the table's own schema."""
    ev = _events(spark, sf_dir)
    schema = StructType([f for f in ev.schema.fields])
    enc = K.encode_rows(ev, ev.columns, out="value")
    return enc.select(parse_exact(F.col("value"), schema).alias("r")).select("r.*")


@query("ticker_flatten", ("PRJ-6",), oracle="""
SELECT event_id, value AS price, value AS volume_24h, user_id AS market_cap,
       event_type AS symbol, ts AS timestamp FROM events""")
def ticker_flatten(spark, sf_dir):
    """Raw nested ticker documents -> flat ticks (ATH fields dropped)."""
    f = K.flatten_ticker(E.ticker_documents(_events(spark, sf_dir)), keep=["event_id"])
    return f.select("event_id", "price", "volume_24h", "market_cap", "symbol",
                    F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query("explode_structs", ("FLT-8", "PRJ-4", "PRJ-5", "Q17", "Q18"), oracle=f"""
SELECT event_id, CAST(value AS REAL) AS price, value AS volume_24h, user_id AS market_cap,
       event_type AS {SC.ARRAY_SYMBOL_FIELD} FROM events""")
def explode_structs(spark, sf_dir):
    """Array-of-struct payloads -> one row per element, flattened."""
    e = K.explode_payload(E.array_payloads(_events(spark, sf_dir)), keep=["event_id"])
    return e.select("event_id", "price", "volume_24h", "market_cap", SC.ARRAY_SYMBOL_FIELD)
