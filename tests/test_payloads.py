import datetime as dt


from tickflow import schemas as S
from tickflow.sources import ticks as K

SAMPLE = ('{"price": 100.5, "volume_24h": 1200.25, "volume_24h_change_24h": -1.5, '
          '"market_cap": 5000000, "market_cap_change_24h": 0.25, "percent_change_15m": 0, '
          '"percent_change_30m": 0.5, "percent_change_1h": -0.75, "percent_change_6h": 1.25, '
          '"percent_change_12h": -2.5, "percent_change_24h": -4.0, "percent_change_7d": 8.0, '
          '"percent_change_30d": 16.0, "percent_change_1y": 32.0, "symbol": "XYZ", '
          '"beta_value": 1.5, "timestamp": "2024-03-04T05:06:07Z"}')


def _texts(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, json_string string")


def test_sample_tick_parses_completely(spark):
    p = K.parse_ticks(_texts(spark, [SAMPLE]), keep=["id"]).first()
    assert p["valid"] and p["market_cap"] == 5000000
    assert p["timestamp"] == dt.datetime(2024, 3, 4, 5, 6, 7)
    f = K.percent_to_fraction(K.parse_ticks(_texts(spark, [SAMPLE]))).first()
    assert f["percent_change_24h"] == -0.04


def test_bad_records_are_quarantined(spark):
    texts = ["null", '{"price": 1', '{"price": 2.0, "market_cap": 3.5, "timestamp": "2024-01-01T00:00:00Z"}',
             '{"price": 2.0}', SAMPLE]
    good, bad = K.split_valid(K.parse_ticks(_texts(spark, texts), keep=["id"]))
    assert sorted(r["id"] for r in good.collect()) == [2, 4]
    g2 = good.filter("id = 2").first()
    assert g2["market_cap"] is None and g2["price"] == 2.0
    reasons = {r["id"]: r["reason"] for r in bad.collect()}
    assert reasons == {0: "no_timestamp", 1: "no_timestamp", 3: "no_timestamp"}
    assert all(r["json_string"] for r in bad.collect())


def test_ticker_document_flatten(spark):
    doc = ('{"symbol": "XYZ", "beta_value": 0.9, "last_updated": "2024-03-04T05:06:07Z", '
           '"quotes": {"USD": {"price": 5.0, "market_cap": 7, "ath_price": 9.0, '
           '"ath_date": "2020-01-02T03:04:05Z", "percent_from_price_ath": -10.0}}}')
    f = K.flatten_ticker(_texts(spark, [doc, "not json"]), keep=["id"]).orderBy("id").collect()
    assert f[0]["price"] == 5.0 and f[0]["symbol"] == "XYZ" and "ath_price" not in f[0]
    assert f[0]["timestamp"] == dt.datetime(2024, 3, 4, 5, 6, 7)
    assert f[1]["price"] is None


def test_array_payload_explodes(spark):
    t = '{"data": [{"price": 1.5, "market_cap": 5000000, "BTC": "x"}, {"price": 2.5, "BTC": "y"}]}'
    e = K.explode_payload(_texts(spark, [t]), keep=["id"]).collect()
    assert [(r["price"], r["BTC"]) for r in e] == [(1.5, "x"), (2.5, "y")]
    assert e[0]["market_cap"] == 5000000
    assert [f.name for f in S.ARRAY_ITEM.fields] == [c for c in e[0].asDict() if c != "id"]


def test_binary_value_to_text(spark):
    df = spark.createDataFrame([(bytearray(SAMPLE, "utf-8"),)], "value binary")
    assert K.as_text(df).first()["json_string"] == SAMPLE


def test_number_types_that_drift_are_widened(spark):
    from decimal import Decimal

    from tickflow.sources.ticks import parse_ticks_any
    at = '"timestamp": "2024-01-02T03:04:05Z"'
    caps = ["12", "12.25", '"12.5"', '{"usd": 1}', '"many"', "1e3", "null", "9e40"]
    rows = [(i, f'{{"price": 1, "market_cap": {c}, {at}}}') for i, c in enumerate(caps)]
    rows += [(90, "null"), (91, "{broken"), (92, None), (93, f'{{"price": "2.5", {at}}}'),
             (94, '{"price": 2, "timestamp": "no time"}'), (95, "[1, 2]")]
    df = spark.createDataFrame(rows, "_v long, json_string string")
    got = {r["_v"]: r for r in parse_ticks_any(df, keep=["_v"]).collect()}
    assert len(got) == len(rows)
    assert [got[i]["market_cap"] for i in range(8)] == [
        Decimal(12), Decimal("12.25"), Decimal("12.5"), None, None, Decimal(1000), None, None]
    assert [got[i]["valid"] for i in range(8)] == [True] * 8
    assert [got[i]["valid"] for i in (90, 91, 92, 93, 94, 95)] == [False] * 3 + [True] + [False] * 2
    assert got[93]["price"] == 2.5
