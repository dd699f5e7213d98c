"""Golden values of FIXTURES.md section 2 and the venue examples of 1.1/1.2."""

import json

import pytest
from pyspark.sql import functions as F

from tradewatch.functions.columns import lin_correlation_id, norm_product_id, norm_symbol, norm_symbol_usd
from tradewatch.operators import normalize as N
from tradewatch.operators.lineage import lin_config_hash
from tradewatch.operators.spread import spread
from tradewatch.operators.volume import vol_zscore
from tradewatch.operators.whale import whale_detect
from tradewatch.config import make_config


@pytest.mark.parametrize("ex,sym,ts,want", [
    ("binance", "btcusdt", "2025-02-05T10:30:00Z", "63aa121cb5984a90"),
    ("coinbase", "btcusdt", "2025-02-05T10:30:00Z", "6884f87ddab62e8c"),
    ("binance", "BTC-USDT", "2023-01-01T00:00:00.123Z", "047d970c2e3ca8b0"),
    ("coinbase", "BTC-USDT", "2014-11-07T08:19:27.028Z", "65c472fd95619d9a"),
])
def test_correlation_id(spark, ex, sym, ts, want):
    df = spark.createDataFrame([(ex, sym, ts)], "exchange string, symbol string, ts string")
    assert df.select(lin_correlation_id("exchange", "symbol", "ts")).first()[0] == want


def test_config_hash():
    h = lin_config_hash({"threshold": 2.5, "window_seconds": 60})
    assert h == "1b2e6df6dfecb69ca9d029f84f48e23cea09a06edc50b18c9e1ef949d38657f7"
    assert len(h) == 64
    assert lin_config_hash({"window_seconds": 60, "threshold": 2.5}) == h


def test_zscore_golden(spark):
    df = spark.createDataFrame([(1500000.0, 450000.0, 318182.0)], "window_volume double, rolling_mean double, "
                                                                    "rolling_stddev double")
    r = vol_zscore(df).first()
    assert round(r.z_score, 4) == 3.3
    assert r.severity == "medium" and r.direction == "up"


def test_spread_golden(spark):
    df = spark.createDataFrame(
        [("2025-01-01 00:00:00", "2025-01-01 00:00:30", "BTC-USDT", "binance", 67450.0),
         ("2025-01-01 00:00:00", "2025-01-01 00:00:30", "BTC-USDT", "coinbase", 66965.0),
         ("2025-01-01 00:00:30", "2025-01-01 00:01:00", "BTC-USDT", "binance", 67000.0)],
        "window_start string, window_end string, symbol string, exchange string, vwap double")
    rows = spread(df).collect()
    assert len(rows) == 1  # a one-venue window gives no row
    assert round(rows[0].spread_pct, 4) == 0.7243
    assert (rows[0].exchange_a, rows[0].exchange_b) == ("binance", "coinbase")


def test_whale_boundary(spark):
    df = spark.createDataFrame([("a", 99999.99), ("b", 100000.00), ("c", 100000.01), ("d", 500000.01),
                                ("e", 1000000.01)], "event_id string, quote_volume double")
    got = {r.event_id: r.severity for r in whale_detect(df, make_config()).collect()}
    assert got == {"c": "medium", "d": "high", "e": "critical"}


def test_symbol_maps(spark):
    df = spark.createDataFrame([("BTCUSDT", "BTC-USD", "btcusdt"), ("ethbtc", "ETH-BTC", "ethbtc"),
                                ("soleth", "SOL-ETH", "soleth"), ("XRPBNB", "XRP-BNB", "xrpbnb")],
                               "a string, b string, c string")
    r = df.select(norm_symbol("a"), norm_symbol_usd("b"), norm_product_id("c")).collect()
    assert [x[0] for x in r] == ["BTC-USDT", "ETH-BTC", "SOL-ETH", "XRPBNB"]
    assert [x[1] for x in r] == ["BTC-USDT", "ETH-BTC", "SOL-ETH", "XRP-BNB"]
    assert [x[2] for x in r] == ["BTC-USD", "ETH-BTC", "SOL-ETH", "XRPBNB"]


def _venue_a(m: bool, envelope: bool):
    body = {"e": "trade", "E": 1672531200124, "s": "BTCUSDT", "t": 26129417, "p": "16500.10", "q": "0.001",
            "b": 1, "a": 2, "T": 1672531200123, "m": m, "M": True}
    return json.dumps({"stream": "btcusdt@trade", "data": body} if envelope else body)


def test_venue_a(spark):
    df = spark.createDataFrame([(_venue_a(False, False),), (_venue_a(True, True),)], "value string")
    rows = N.norm_venue_a(N.norm_unwrap(df), ingested_at="2024-01-01 00:00:00").orderBy("side").collect()
    buy, sell = rows
    assert buy.event_id == "26129417" and buy.symbol == "BTC-USDT" and buy.price == 16500.10
    assert abs(buy.quote_volume - 16.5001) < 1e-4 and buy.side == "buy" and sell.side == "sell"
    iso = spark.createDataFrame([buy]).select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()[0]
    assert iso == "2023-01-01T00:00:00.123Z"


def test_venue_b(spark):
    match = {"type": "match", "trade_id": 10, "sequence": 50, "maker_order_id": "m", "taker_order_id": "t",
             "time": "2014-11-07T08:19:27.028459Z", "product_id": "BTC-USD", "size": "5.23512", "price": "400.23",
             "side": "sell"}
    last = dict(match, type="last_match", trade_id=11, time="2025-01-01T00:00:00.000000Z")
    df = spark.createDataFrame([(json.dumps(match),), (json.dumps(last),), ('{"type":"heartbeat"}',),
                                ('{"type":"subscriptions"}',)], "value string")
    out = N.norm_venue_b(df, ingested_at="2024-01-01 00:00:00").withColumn(
        "iso", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).orderBy("event_id").collect()
    assert len(out) == 2
    assert out[0].event_id == "10" and out[0].symbol == "BTC-USDT" and out[0].side == "sell"
    assert abs(out[0].quote_volume - 2095.2521) < 0.01
    assert out[0].iso == "2014-11-07T08:19:27.028Z"  # truncated, not rounded
    assert out[1].iso == "2025-01-01T00:00:00.000Z"
