"""Stand-in tick input from the driver's ``events`` table.

These functions only rename columns into the tick schema the jobs expect
(symbol, ts, close, volume, tiebreak); they do none of the jobs' work.
Mapping (FIXTURES.md): symbol = event_type, close = volume = value,
tiebreak = event_id. ``single_series`` treats all events as one instrument,
the reference's one-series shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import schemas as S
from tickflow.sources.tables import read_table

SINGLE_SYMBOL = "ALL"


def ticks_from_events(events: DataFrame, single_series: bool = False) -> DataFrame:
    symbol = F.lit(SINGLE_SYMBOL) if single_series else F.col("event_type")
    return events.select(symbol.alias("symbol"), F.col("ts"), F.col("value").alias("close"),
                         F.col("value").alias("volume"), F.col("event_id").alias("tiebreak"))


def read_ticks(spark: SparkSession, sf_dir: str, single_series: bool = False) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ticks_from_events(ev, single_series)


# --------------------------------------------------------------------------- payloads
# Stand-in message payloads in the feed's JSON shapes, one per event row.
# Variants follow the event type so that the invalid cases the parser must
# handle are present: 'error' events carry the text ``null`` (the producer's
# failed poll), 'signup' events lack the event time, 'click' events carry a
# fractional market_cap. The parsers never look at the event type.

def _iso(ts: str = "ts"):
    return F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def tick_documents(events: DataFrame, out: str = "json_string") -> DataFrame:
    """events -> (event_id, F3 tick JSON text)."""
    base = [F.col("value").alias("price"), F.col("value").alias("volume_24h")]
    full = F.to_json(F.struct(*base, F.col("user_id").alias("market_cap"),
                              F.col("event_type").alias("symbol"), _iso().alias("timestamp")))
    no_time = F.to_json(F.struct(*base, F.col("user_id").alias("market_cap"),
                                 F.col("event_type").alias("symbol")))
    frac_cap = F.to_json(F.struct(*base, (F.col("user_id") + F.lit(0.5)).alias("market_cap"),
                                  F.col("event_type").alias("symbol"), _iso().alias("timestamp")))
    et = F.col("event_type")
    text = (F.when(et == "error", F.lit("null")).when(et == "signup", no_time)
            .when(et == "click", frac_cap).otherwise(full))
    return events.select("event_id", text.alias(out))


def drifting_documents(events: DataFrame, out: str = "json_string") -> DataFrame:
    """``tick_documents`` of a feed that changes its number types: the market cap
    is a fraction in 'click' events, text in 'purchase' events, an object in
    'view' events and a whole number else; the price of 'purchase' is text too."""
    et, uid = F.col("event_type"), F.col("user_id")
    time = _iso().alias("timestamp")
    sym = et.alias("symbol")

    def doc(cap, price=F.col("value")):
        return F.to_json(F.struct(price.alias("price"), cap.alias("market_cap"), sym, time))

    text = (F.when(et == "error", F.lit("null"))
            .when(et == "click", doc(uid.cast("decimal(20,0)") + F.lit(0.25).cast("decimal(3,2)")))
            .when(et == "purchase", doc(uid.cast("string"), F.col("value").cast("string")))
            .when(et == "view", doc(F.struct(uid.alias("usd")))).otherwise(doc(uid)))
    return events.select("event_id", text.alias(out))


def ticker_documents(events: DataFrame, out: str = "json_string") -> DataFrame:
    """events -> (event_id, F4 raw ticker document JSON text)."""
    usd = F.struct(F.col("value").alias("price"), F.col("value").alias("volume_24h"),
                   F.col("user_id").alias("market_cap"),
                   (F.col("value") * F.lit(2.0)).alias("ath_price"),
                   _iso().alias("ath_date"), F.lit(-50.0).alias("percent_from_price_ath"))
    doc = F.struct(F.col("event_type").alias("symbol"), _iso().alias("last_updated"),
                   F.struct(usd.alias("USD")).alias("quotes"))
    return events.select("event_id", F.to_json(doc).alias(out))


def array_payloads(events: DataFrame, out: str = "json_string") -> DataFrame:
    """events -> (event_id, F4b ``{"data": [...]}`` JSON text, one element)."""
    item = F.struct(F.col("value").alias("price"), F.col("value").alias("volume_24h"),
                    F.col("user_id").alias("market_cap"),
                    F.col("event_type").alias(S.ARRAY_SYMBOL_FIELD))
    return events.select("event_id", F.to_json(F.struct(F.array(item).alias("data"))).alias(out))
