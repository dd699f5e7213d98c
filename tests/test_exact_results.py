"""Results on inputs that the driver's tables do not hold: several venues, many
contributions, silent feeds, records that are no trades."""

import datetime as dt

from pyspark.sql import functions as F

from tradewatch.operators import flow as FL
from tradewatch.operators import normalize as N
from tradewatch.operators import quality as Q
from tradewatch.operators.serving import lag_monitor
from tradewatch.operators.spread import spread, spread_alerts, vwap
from tradewatch.operators.wallet import wallet_high_alpha

T0 = dt.datetime(2024, 1, 1)


def test_spread_takes_the_widest_of_three_venues(spark):
    rows = [(T0, T0, "X", v, p) for v, p in (("a", 100.0), ("b", 100.4), ("c", 100.8))] + [(T0, T0, "Y", "a", 1.0)]
    s = spread(spark.createDataFrame(rows, "window_start timestamp, window_end timestamp, symbol string, exchange string, vwap double"))
    r = s.collect()
    assert [(x.symbol, x.exchange_a, x.exchange_b) for x in r] == [("X", "a", "c")]
    assert spread_alerts(s).count() == 1


def _signals(spark, flows):
    vol = spark.createDataFrame([], "window_start timestamp, symbol string, severity string, z_score double, alert_id string")
    whales = spark.createDataFrame([(T0, "X", "critical", f"w{i}", f"e{i}", "a") for i in range(5)],
                                   "timestamp timestamp, symbol string, severity string, alert_id string, event_id string, exchange string")
    fl = spark.createDataFrame(flows, "window_start timestamp, symbol string, flow_ratio double, buy_volume double, sell_volume double, alert_id string")
    return vol, whales, fl


def test_consensus_direction_over_several_flow_windows(spark):
    flows = [(T0, "X", 0.05, 5.0, 95.0, "f1"), (T0 + dt.timedelta(minutes=5), "X", 0.55, 0.55, 0.45, None)]
    inputs = _signals(spark, flows)
    r = FL.consensus_signals(*inputs, "10 minutes").first()
    assert abs(r.flow_ratio - 5.55 / 101) < 1e-12 and r.contributing == 6
    ids = [x.alert_id for x in FL.consensus_contributions(*inputs, "10 minutes").collect()]
    assert sorted(ids) == ["f1", "w0", "w1", "w2", "w3", "w4"]


def test_high_alpha_is_exact_for_many_wallets(spark):
    n = 20_001
    s = spark.range(n).select(F.col("id").alias("wallet"), F.lit("solana").alias("blockchain"), F.lit(T0).alias("scored_at"),
                              (F.col("id") * 7919 % n).cast("double").alias("alpha"), F.lit(9).alias("trade_count"))
    a = wallet_high_alpha(s)
    k = -(-95 * n // 100)
    assert a.count() == n - k
    assert float(a.select(F.get_json_object("details", "$.threshold").alias("t")).first().t) == k - 1


def test_lag_percentile_is_exact(spark):
    t = spark.range(15_000).select(F.lit("a").alias("exchange"), F.lit(T0).alias("timestamp"),
                                   F.timestamp_micros(F.unix_micros(F.lit(T0)) + F.col("id") * 1000).alias("ingestion_timestamp"))
    r = lag_monitor(t, "1 hour").first()
    assert (r.records, r.max_lag_s, r.p95_lag_s) == (15_000, 14.999, 14.249)


def test_gap_reports_silent_head_and_tail(spark):
    h = dt.timedelta(hours=1)
    rows = [("a", "X", T0 + i * h) for i in range(5)] + [("b", "X", T0 + 2 * h)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, timestamp timestamp")
    got = sorted((r.exchange, (r.window_start - T0) // h) for r in Q.dq_stream_gap(df, 3600).collect())
    assert got == [("b", 0), ("b", 1), ("b", 3), ("b", 4)]
    later = Q.dq_stream_gap(df, 3600, as_of=T0 + 6 * h).collect()
    assert sum(r.exchange == "a" for r in later) == 2


GOOD = '{"event_id": "1", "exchange": "binance", "symbol": "BTC-USDT", "price": 1.5, "quantity": 2, "quote_volume": 3, "side": "buy", "timestamp": "2024-01-01T00:00:00.000Z"}'


def test_bad_records_become_dead_letters(spark):
    values = [GOOD, GOOD.replace(", ", ",\n "), GOOD.replace("2024-01-01T", "yesterday "), GOOD.replace("1.5", '"dear"'), GOOD[:40],
              "[1, 2]", "", None, GOOD.replace('"price": 1.5', '"price": null')]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "key long, value string")
    got = {r.key: (r.failed_rules, r.price) for r in Q.dq_schema(df).collect()}
    assert [got[i][0] for i in range(9)] == [[], [], *[["malformed"]] * 6, []]
    assert got[1][1] == 1.5 and got[3][1] is None


def test_venue_messages_with_bad_fields_give_nulls(spark):
    a = spark.createDataFrame([('{"e":"trade","s":"BTCUSDT","t":1,"p":"x","q":"2","T":"soon","m":true}',)], "value string")
    r = N.norm_venue_a(a).first()
    assert r.price is None and r.timestamp is None and r.quantity == 2.0
    b = spark.createDataFrame([('{"type":"match","trade_id":1,"time":"never","product_id":"BTC-USD","size":"big","price":"1","side":"buy"}',)], "value string")
    r = N.norm_venue_b(b).first()
    assert r.timestamp is None and r.quantity is None and r.price == 1.0


def test_skewed_clock_is_flagged_on_both_sides(spark):
    m = dt.timedelta(minutes=1)
    rows = [(T0, T0 + 6 * m), (T0, T0), (T0 + 6 * m, T0)]
    got = Q.dq_late_flag(spark.createDataFrame(rows, "timestamp timestamp, ingestion_timestamp timestamp")).collect()
    assert [(r.is_late, r.is_early) for r in got] == [(True, False), (False, False), (False, True)]


def test_numbers_beyond_exact_sums_are_dead_letters(spark):
    rows = [("ok", 100.0, 1.0, 100.0), ("nan", float("nan"), 1.0, 1.0), ("inf", float("inf"), 1.0, 1.0), ("big", 1e30, 1.0, 1.0), ("minus", -float("inf"), 1.0, 1.0),
            ("product", 1e15, 1e15, 1.0), ("volume", 1.0, 1.0, float("nan")), ("null", None, 1.0, None), ("null2", None, -1.0, None)]
    df = spark.createDataFrame(rows, "event_id string, price double, quantity double, quote_volume double").withColumn("failed_rules", Q.empty())
    assert {r.event_id for r in Q.dq_valid_range(df).where("size(failed_rules) > 0").collect()} == {"nan", "inf", "big", "minus", "product", "volume", "null2"}


def test_vwap_leaves_out_trades_that_have_no_exact_product(spark):
    rows = [("1", 100.0, 2.0), ("2", float("nan"), 5.0), ("3", 1e30, 5.0), ("4", 50.0, float("inf")), ("5", None, 7.0), ("6", 50.0, None), ("7", 200.0, 2.0)]
    df = spark.createDataFrame([(T0, "X", "a", *r) for r in rows], "timestamp timestamp, symbol string, exchange string, event_id string, price double, quantity double")
    assert [r.vwap for r in vwap(df).collect()] == [150.0]


def test_overlong_epochs_become_null(spark):
    rows = ['{"e":"trade","E":1,"s":"BTCUSDT","t":%d,"p":"1","q":"1","T":%d,"m":true}' % x for x in ((1, 2 ** 63 - 1), (2, -2 ** 63), (3, 1_700_000_000_000))]
    got = N.norm_venue_a(spark.createDataFrame([(r,) for r in rows], "value string"), ingested_at="2024-01-01").collect()
    assert [(r.event_id, r.timestamp is None) for r in got] == [("1", True), ("2", True), ("3", False)]


def test_symbol_alpha_counts_each_named_wallet_once(spark):
    from tradewatch.operators.wallet import alpha_by_symbol, alpha_percentile, wallet_scores_periodic
    rets = {1: [.1, -.1, .3], 2: [.1, -.3, .1], 3: [.2, -.1, .5], None: [.4, -.1, .4]}
    rows = [(w, "solana", f"2024-01-01 0{i}:00:00", f"{w}-{i}", r, s) for w, x in rets.items() for i, r in enumerate(x)
            for s in (["X", "Y"] if w == 1 else ["X"])]
    t = spark.createDataFrame(rows, "wallet long, blockchain string, at string, event_id string, ret double, symbol string").withColumn("ts", F.col("at").cast("timestamp"))
    ranked = alpha_percentile(wallet_scores_periodic(t, "3 days", 1, symbols=True))
    rank = {r.wallet: r.alpha_percentile for r in ranked.collect()}
    got = {r.symbol: r.alpha_pct for r in alpha_by_symbol(ranked).collect()}
    assert set(rank) == {1, 2, 3, None} and rank[None] is not None
    assert {k: round(v, 6) for k, v in got.items()} == {"X": round((rank[1] + rank[2] + rank[3]) / 3, 6), "Y": round(rank[1], 6)}
