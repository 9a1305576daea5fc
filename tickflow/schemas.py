"""Explicit schemas. Nothing in the package infers types from data."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, FloatType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

# The numeric fields of a ticker quote, in the order the
# ticker feed publishes them.
QUOTE_NUMERIC_FIELDS = [
    "price", "volume_24h", "volume_24h_change_24h", "market_cap",
    "market_cap_change_24h", "percent_change_15m", "percent_change_30m",
    "percent_change_1h", "percent_change_6h", "percent_change_12h",
    "percent_change_24h", "percent_change_7d", "percent_change_30d",
    "percent_change_1y",
]
# Quote fields the flattened tick drops.
ATH_FIELDS = ["ath_price", "ath_date", "percent_from_price_ath"]

# Names in the historical minute files and the feed formats.
VOLUME_BASE_COL = "Volume BTC"      # minute files: volume in the base asset
VOLUME_QUOTE_COL = "Volume USD"     # minute files: volume in the quote currency
MINUTE_SYMBOL = "BTC/USD"           # symbol literal written into minute files
ARRAY_SYMBOL_FIELD = "BTC"          # symbol field of the array payload items
DEFAULT_TOPIC = "bitcoin"           # topic the feed publishes to


def _num(name: str):
    return StructField(name, LongType() if name == "market_cap" else DoubleType(), True)


# one tick as published to the topic (17 nullable fields).
TICK = StructType(
    [_num(n) for n in QUOTE_NUMERIC_FIELDS]
    + [StructField("symbol", StringType(), True),
       StructField("beta_value", DoubleType(), True),
       StructField("timestamp", TimestampType(), True)])

# Older 19-field variant: carries the all-time-high fields, no timestamp.
TICK_WITH_ATH = StructType(
    [_num(n) for n in QUOTE_NUMERIC_FIELDS]
    + [StructField("ath_price", DoubleType(), True),
       StructField("ath_date", StringType(), True),
       StructField("percent_from_price_ath", DoubleType(), True),
       StructField("symbol", StringType(), True),
       StructField("beta_value", DoubleType(), True)])

# raw ticker document as returned by the price API.
QUOTE_USD = StructType(
    [_num(n) for n in QUOTE_NUMERIC_FIELDS]
    + [StructField("ath_price", DoubleType(), True),
       StructField("ath_date", StringType(), True),
       StructField("percent_from_price_ath", DoubleType(), True)])
TICKER_DOC = StructType([
    StructField("symbol", StringType(), True),
    StructField("beta_value", DoubleType(), True),
    StructField("last_updated", StringType(), True),
    StructField("quotes", StructType([StructField("USD", QUOTE_USD, True)]), True),
])

# F4b: array payload ``{"data": [ {...}, ... ]}``; market_cap widened to long (Q17).
ARRAY_ITEM = StructType(
    [StructField("price", FloatType(), True),
     StructField("volume_24h", DoubleType(), True),
     StructField("volume_24h_change_24h", FloatType(), True),
     StructField("market_cap", LongType(), True),
     StructField("market_cap_change_24h", FloatType(), True)]
    + [StructField(n, FloatType(), True) for n in QUOTE_NUMERIC_FIELDS[5:]]
    + [StructField(ARRAY_SYMBOL_FIELD, StringType(), True),
       StructField("beta_value", FloatType(), True)])
ARRAY_PAYLOAD = StructType([StructField("data", ArrayType(ARRAY_ITEM), True)])

# raw historical minute bars (times are zone-free UTC wall clock).
RAW_MINUTE_CSV = StructType([
    StructField("timestamp", TimestampNTZType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", DoubleType(), True),
    StructField("quote_asset_volume", DoubleType(), True),
])

# normalised minute bars, one CSV per year.
MINUTE_CSV = StructType([
    StructField("unix", LongType(), True),
    StructField("date", TimestampNTZType(), True),
    StructField("symbol", StringType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField(VOLUME_BASE_COL, DoubleType(), True),
    StructField(VOLUME_QUOTE_COL, DoubleType(), True),
])

# stored predictions (label, P(class 1), price, time). Times are UTC
# wall-clock values without a zone, like every bar time in the engine.
PREDICTIONS_CSV = StructType([
    StructField("label", DoubleType(), True),
    StructField("prob", DoubleType(), True),
    StructField("price", DoubleType(), True),
    StructField("time", TimestampNTZType(), True),
])

# Canonical tick row used by every bar/feature transform.
TICK_COLUMNS = ["symbol", "ts", "close", "volume", "tiebreak"]
