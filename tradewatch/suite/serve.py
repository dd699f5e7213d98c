"""Registered queries: alert assembly, lineage lookups, run_modules, serving
and monitors (SURVEY 2.3, 2.11, 2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.functions.columns import alert_id as alert_id_col
from tradewatch.functions.columns import stable_round
from tradewatch.operators import alerts as AL
from tradewatch.operators import lineage as L
from tradewatch.operators import quality as Q
from tradewatch.operators import serving as SV
from tradewatch.operators import volume as V
from tradewatch.plans.modules import run_modules
from tradewatch.session import scratch_path
from tradewatch.sources import adapters as A
from tradewatch.suite import core, detect
from tradewatch.suite.core import WHALE_ALERTS_SQL, dirty_flagged, whales_with_lineage
from tradewatch.suite.detect import SPREAD_ALERTS_SQL, SPREAD_SQL, VOL_SQL, spread_alerts, spreads, vol_alerts
from tradewatch.suite.identity import CONS_SQL
from tradewatch.suite.oracle import TRADES_E, config_hash, corr_id, sround, ttl, with_
from tradewatch.suite.registry import PROCESSED_AT, query, sql
from tradewatch.operators.lineage import lin_config_hash

RUN_CFG = make_config({
    "volume_anomaly": {"window_seconds": 3600, "rolling_window_seconds": 259200},
    "spread_calculator": {"window_seconds": 3600},
    "flow": {"window_seconds": 21600}, "consensus": {"window_seconds": 21600},
    "wallet_scorer": {"period_days": 3, "min_trades": 5, "score_delta": 0.2},
    "dex": {"liquidity_window_seconds": 604800, "liquidity_change_pct": 10.0}})
WHALE_HASH = config_hash("whale_detector")
VOL_HASH = lin_config_hash(detect.CFG["volume_anomaly"])
SPREAD_HASH = lin_config_hash(detect.CFG["spread_calculator"])
BASE = ["alert_id", "alert_type", "module_id", "symbol", "exchange", "severity", "detected_at", "message", "ttl_epoch"]
BASE_SQL = ", ".join(BASE)


def small_alerts(spark, sf):
    """Small-tier alerts (MOD-001 to MOD-003) in one frame."""
    return AL.alert_union(core.whale_alerts(whales_with_lineage(spark, sf)), vol_alerts(spark, sf),
                          spread_alerts(spark, sf))


def _lin(name):
    return F.get_json_object("details", f"$._lineage.{name}")


SMALL_SQL = with_(TRADES_E, WHALE_ALERTS_SQL) + VOL_SQL + CONS_SQL + SPREAD_SQL + SPREAD_ALERTS_SQL + f""",
small AS (
  SELECT {BASE_SQL}, d_correlation_id AS correlation_id, event_id AS source_event_id,
    '{WHALE_HASH}' AS config_hash, '_lineage,event_id,price,quantity,quote_volume,side' AS details_keys,
    d_quote_volume AS quote_volume FROM whale_alerts
  UNION ALL
  SELECT {BASE_SQL}, correlation_id, last_event_id, '{VOL_HASH}',
    '_lineage,direction,rolling_mean,rolling_stddev,trade_count,window_start,window_volume,z_score', NULL
  FROM vol_alerts
  UNION ALL
  SELECT {BASE_SQL}, correlation_id, last_event_id, '{SPREAD_HASH}', '_lineage,exchange_a,exchange_a_vwap,exchange_b,exchange_b_vwap,spread_pct,window_start',
    NULL FROM spread_alerts)"""


@query("alert_build")
def q_alert_build(spark, sf):
    a = small_alerts(spark, sf)
    return a.select(*BASE, F.array_join(F.array_sort(F.json_object_keys("details")), ",").alias("details_keys"))


sql("alert_build", SMALL_SQL + f"\nSELECT {BASE_SQL}, details_keys FROM small")


@query("alert_id")
def q_alert_id(spark, sf):
    """The same finding gets the same id from the detector and from the
    venue-normalised feed (two independent paths)."""
    cfg = core.CFG
    via_feed = core.whale_detect(core.venue_a_norm(spark, sf).unionByName(core.venue_b_norm(spark, sf)), cfg)
    via_feed = via_feed.select("event_id", alert_id_col(F.lit("whale_trade"), "exchange", "symbol", "event_id")
                               .alias("feed_alert_id"))
    direct = core.whale_alerts(whales_with_lineage(spark, sf)).select(
        F.get_json_object("details", "$.event_id").alias("event_id"), "alert_id")
    return direct.join(via_feed, "event_id", "full").select("event_id", "alert_id", "feed_alert_id")


sql("alert_id", with_(TRADES_E, WHALE_ALERTS_SQL) + """
SELECT event_id, alert_id, alert_id AS feed_alert_id FROM whale_alerts""")


@query("alert_ttl")
def q_alert_ttl(spark, sf):
    a = small_alerts(spark, sf)
    clock = a.agg(F.max("detected_at") - F.expr("INTERVAL 12 HOURS")).scalar()
    return AL.alert_ttl(a, clock).select("alert_id", "alert_type", "ttl_epoch")


sql("alert_ttl", SMALL_SQL + f""",
clk AS (SELECT max(detected_at) - INTERVAL 12 HOUR AS as_of FROM small)
SELECT alert_id, alert_type, {ttl('detected_at')} AS ttl_epoch FROM small, clk
WHERE {ttl('detected_at')} > epoch_us(as_of) // 1000000""")


@query("alert_union")
def q_alert_union(spark, sf):
    return small_alerts(spark, sf).select(*BASE)


sql("alert_union", SMALL_SQL + f"\nSELECT {BASE_SQL} FROM small")


@query("alert_registry_check")
def q_alert_registry_check(spark, sf):
    a = AL.alert_registry_check(AL.alert_union(*run_modules(
        A.trades_e(spark, sf), RUN_CFG, ("MOD-001", "MOD-002", "MOD-003", "MOD-006", "MOD-007"),
        PROCESSED_AT).values()))
    return a.select("alert_id", "alert_type", "severity", "registered", "severity_ok",
                    F.coalesce("module_ok", F.lit(False)).alias("module_ok"))


RUN_SQL = SMALL_SQL + f""",
run_all AS (
  SELECT {BASE_SQL} FROM small
  UNION ALL
  SELECT {core.alert_id('alert_type', 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')}, alert_type, 'MOD-006',
    symbol, NULL, severity, window_end,
    printf('%s on %s: %d buy vs %d sell USD', alert_type, symbol, CAST(floor(buy_volume) AS BIGINT),
           CAST(floor(sell_volume) AS BIGINT)), {ttl('window_end')} FROM fla
  UNION ALL
  SELECT {core.alert_id("CASE WHEN flow_ratio > 0.5 THEN 'consensus_bullish' ELSE 'consensus_bearish' END", 'NULL',
                        'symbol', 'epoch_us(window_start) // 1000000')},
    CASE WHEN flow_ratio > 0.5 THEN 'consensus_bullish' ELSE 'consensus_bearish' END, 'MOD-007', symbol, NULL,
    CASE WHEN consensus_score > 85 THEN 'high' ELSE 'medium' END, window_end,
    CASE WHEN flow_ratio > 0.5 THEN 'consensus_bullish' ELSE 'consensus_bearish' END || ' on ' || symbol,
    {ttl('window_end')}
  FROM cscore WHERE consensus_score > 70 AND flow_ratio IS NOT NULL AND flow_ratio <> 0.5)"""

sql("alert_registry_check", RUN_SQL + """
SELECT alert_id, alert_type, severity, true AS registered,
  CASE WHEN alert_type = 'whale_trade' THEN severity IN ('medium', 'high', 'critical')
       ELSE severity IN ('medium', 'high') END AS severity_ok, true AS module_ok
FROM run_all""")


@query("run_modules")
def q_run_modules(spark, sf):
    out = run_modules(A.trades_e(spark, sf), RUN_CFG, ("MOD-007", "MOD-003"), PROCESSED_AT)
    return AL.alert_union(*out.values()).select(*BASE)


sql("run_modules", RUN_SQL + f"\nSELECT {BASE_SQL} FROM run_all")


# ---- lineage lookups ------------------------------------------------------------------------------

LATEST_CID_SQL = f""",
cid AS (SELECT max_by(d_correlation_id, struct_pack(t := detected_at, e := event_id)) AS cid FROM whale_alerts)"""


def lineage_table(spark, sf):
    """The lineage table of the small tier's alerts, as a run writes it beside them."""
    path = scratch_path(spark, "runs", "lineage", unique=True)
    L.write_lineage(small_alerts(spark, sf), path)
    return spark.read.parquet(path)


@query("lin_by_correlation")
def q_lin_by_correlation(spark, sf):
    """A lookup by id, bounded by the day of the trade it belongs to."""
    w = L.with_correlation_id(core.whale_detect(A.trades_e(spark, sf), core.CFG)).agg(
        F.max_by(F.struct("correlation_id", "timestamp"), F.struct("timestamp", "event_id")).alias("w")).first()["w"]  # one row
    return L.lin_by_correlation(lineage_table(spark, sf), w["correlation_id"], since=w["timestamp"])


sql("lin_by_correlation", SMALL_SQL + LATEST_CID_SQL + f"""
SELECT alert_id, alert_type, detected_at, correlation_id, module_id AS lineage_module_id,
  CASE module_id WHEN 'MOD-002' THEN 'whale-detector' WHEN 'MOD-003' THEN 'spread-calculator'
    ELSE 'volume-anomaly' END AS detector_name, config_hash
FROM small, cid WHERE correlation_id = cid.cid""")


@query("lin_by_config")
def q_lin_by_config(spark, sf):
    return L.lin_by_config(lineage_table(spark, sf), VOL_HASH)


sql("lin_by_config", SMALL_SQL + f"""
SELECT alert_id, module_id, detected_at, count(*) AS alert_count FROM small WHERE config_hash = '{VOL_HASH}'
GROUP BY 1, 2, 3""")


@query("lin_trace_raw")
def q_lin_trace_raw(spark, sf):
    """Every alert traced to its raw trade, or to the one that closed its window, spreads included."""
    return L.lin_trace_raw(lineage_table(spark, sf), A.trades_e(spark, sf)).drop("alert_id")


sql("lin_trace_raw", SMALL_SQL + f""",
tc AS (SELECT *, {corr_id()} AS cid FROM trades_e)
SELECT t.exchange, t.symbol, t.event_id, t.price, t.quantity, s.alert_type, s.detected_at, s.correlation_id
FROM small s JOIN tc t ON s.source_event_id = t.event_id AND s.symbol = t.symbol AND s.correlation_id = t.cid""")


# ---- serving --------------------------------------------------------------------------------------

@query("alerts_query")
def q_alerts_query(spark, sf):
    r = SV.alerts_query(small_alerts(spark, sf), "whale_trade", "BTC-USDT", "2024-01-10 00:00:00", 50)
    return r.select(*BASE, "has_more")


sql("alerts_query", SMALL_SQL + f""",
f AS (SELECT * FROM small WHERE alert_type = 'whale_trade' AND symbol = 'BTC-USDT'
      AND detected_at >= TIMESTAMP '2024-01-10 00:00:00')
SELECT {BASE_SQL}, (SELECT count(*) FROM f) > 50 AS has_more FROM f
ORDER BY detected_at DESC, alert_id DESC LIMIT 50""")


@query("metrics_symbol")
def q_metrics_symbol(spark, sf):
    m = SV.metrics_symbol(A.trades_e(spark, sf), spreads(spark, sf), small_alerts(spark, sf))
    return m.select("symbol", "exchange", "last_price", stable_round("volume_1h", 6).alias("volume_1h"),
                    stable_round("last_spread_pct", 6).alias("last_spread_pct"), "anomaly_count_24h",
                    "last_whale_at", "last_whale_usd", "last_whale_price", "last_whale_quantity", "last_whale_side", "updated_at")


sql("metrics_symbol", SMALL_SQL + f""",
clk AS (SELECT max("timestamp") AS as_of FROM trades_e),
v AS (SELECT symbol, exchange, max_by(price, struct_pack(t := "timestamp", e := event_id)) AS last_price,
        CAST(coalesce(sum(CAST(quote_volume AS DECIMAL(28,8))) FILTER (WHERE "timestamp" > as_of - INTERVAL 1 HOUR), 0)
          AS DOUBLE) AS volume_1h
      FROM trades_e, clk WHERE "timestamp" <= as_of GROUP BY 1, 2),
s AS (SELECT symbol, max_by(spread_pct, window_start) AS last_spread_pct FROM sp, clk WHERE window_end <= as_of
      GROUP BY 1),
a AS (SELECT symbol, count(*) FILTER (WHERE detected_at > as_of - INTERVAL 24 HOUR) AS anomaly_count_24h,
        max(detected_at) FILTER (WHERE alert_type = 'whale_trade') AS last_whale_at,
        max_by(quote_volume, struct_pack(t := detected_at, i := alert_id)) FILTER (WHERE alert_type = 'whale_trade')
          AS last_whale_usd, max_by(source_event_id, struct_pack(t := detected_at, i := alert_id))
          FILTER (WHERE alert_type = 'whale_trade') AS whale_event
      FROM small, clk WHERE detected_at <= as_of GROUP BY 1)
SELECT v.symbol, v.exchange, last_price, {sround('volume_1h', 6)} AS volume_1h, {sround('last_spread_pct', 6)} AS
  last_spread_pct, anomaly_count_24h, last_whale_at, last_whale_usd,
  e.price AS last_whale_price, e.quantity AS last_whale_quantity, e.side AS last_whale_side, as_of AS updated_at
FROM v LEFT JOIN s USING (symbol) LEFT JOIN a USING (symbol)
LEFT JOIN trades_e e ON e.event_id = whale_event AND e.symbol = v.symbol, clk""")


@query("board_volume")
def q_board_volume(spark, sf):
    agg = V.vol_aggregate(A.trades_e(spark, sf), detect.VOL_W)
    return SV.board_volume(agg, small_alerts(spark, sf))


sql("board_volume", SMALL_SQL + """
SELECT b.window_start, b.window_end, b.symbol, b.exchange, b.window_volume, b.trade_count,
  a.severity IS NOT NULL AS is_anomaly, a.severity AS anomaly_severity
FROM vbase b LEFT JOIN (SELECT symbol, exchange, detected_at, severity FROM small WHERE alert_type = 'volume_spike') a
  ON b.symbol = a.symbol AND b.exchange = a.exchange AND b.window_end = a.detected_at""")


@query("board_spread")
def q_board_spread(spark, sf):
    return SV.board_spread(spreads(spark, sf)).withColumn("spread_pct", stable_round("spread_pct", 6))


sql("board_spread", with_(TRADES_E) + SPREAD_SQL + f"""
SELECT window_start, symbol, exchange_a, exchange_b, {sround('spread_pct', 6)} AS spread_pct,
  abs(spread_pct) > 0.5 AS above_threshold FROM sp""")


@query("board_whales")
def q_board_whales(spark, sf):
    return SV.board_whales(core.whale_detect(A.trades_e(spark, sf), core.CFG), 50)


sql("board_whales", with_(TRADES_E) + """
SELECT "timestamp", exchange, symbol, side, quote_volume, event_id FROM trades_e WHERE quote_volume > 100000
ORDER BY "timestamp" DESC, event_id DESC LIMIT 50""")


@query("board_health")
def q_board_health(spark, sf):
    return SV.board_health(A.trades_e(spark, sf)).withColumn("avg_lag_s", stable_round("avg_lag_s", 6))


sql("board_health", with_(TRADES_E) + f"""
SELECT exchange, count(*) AS records, max("timestamp") AS last_seen,
  max((epoch_us(ingestion_timestamp) - epoch_us("timestamp")) / 1000000) AS max_lag_s,
  {sround('avg((epoch_us(ingestion_timestamp) - epoch_us("timestamp")) / 1000000)', 6)} AS avg_lag_s
FROM trades_e GROUP BY exchange""")


# ---- monitors --------------------------------------------------------------------------------------

@query("metrics_counts")
def q_metrics_counts(spark, sf):
    return SV.metrics_counts(small_alerts(spark, sf), "1 day")


sql("metrics_counts", SMALL_SQL + """
SELECT time_bucket(INTERVAL 1 DAY, detected_at, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 1 DAY, detected_at, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end, module_id,
  count(*) AS alert_count FROM small GROUP BY 1, 2, 3""")


@query("alarm_m_of_n")
def q_alarm_m_of_n(spark, sf):
    series = Q.dq_score_series(dirty_flagged(spark, sf), "1 day").withColumn("metric", F.lit("quality_score"))
    a = SV.alarm_m_of_n(series, "pass_rate_pct", 99.0, 2, 3, True, ["metric"])
    return a.select("window_start", "pass_rate_pct", "breach", "breaches_in_n", "alarm")


sql("alarm_m_of_n", with_(TRADES_E, core.DIRTY) + """,
ser AS (SELECT time_bucket(INTERVAL 1 DAY, "timestamp", TIMESTAMP '1970-01-01') AS window_start,
          round(100.0 * count(*) FILTER (WHERE reason IS NULL) / count(*), 6) AS pass_rate_pct
        FROM flagged WHERE "timestamp" IS NOT NULL GROUP BY 1),
b AS (SELECT *, coalesce(pass_rate_pct < 99.0, false) AS breach FROM ser)
SELECT window_start, pass_rate_pct, breach,
  CAST(sum(CAST(breach AS INTEGER)) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT)
    AS breaches_in_n,
  sum(CAST(breach AS INTEGER)) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 2 AS alarm
FROM b""")


@query("alarm_m_of_n_gaps")
def q_alarm_m_of_n_gaps(spark, sf):
    """Lag alarm of every venue, 3 of 4 periods of 15 minutes; a period without any trade is a breach, up to the last period of all venues."""
    lag = SV.lag_monitor(A.trades_e(spark, sf), "15 minutes").select("window_start", "exchange", "max_lag_s")
    a = SV.alarm_m_of_n(lag, "max_lag_s", 400.0, 3, 4, False, ["exchange"], period_seconds=900, missing="breaching",
                        until=lag.agg(F.max("window_start")).scalar())
    return a.select("exchange", "window_start", "max_lag_s", "missing", "breach", "breaches_in_n", "alarm")


sql("alarm_m_of_n_gaps", with_(TRADES_E) + """,
ser AS (SELECT time_bucket(INTERVAL 15 MINUTE, "timestamp", TIMESTAMP '1970-01-01') AS window_start, exchange,
          max(epoch_us(ingestion_timestamp) - epoch_us("timestamp")) / 1000000 AS max_lag_s FROM trades_e GROUP BY 1, 2),
cal AS (SELECT exchange, unnest(generate_series(lo, (SELECT max(window_start) FROM ser), INTERVAL 15 MINUTE)) AS window_start
        FROM (SELECT exchange, min(window_start) AS lo FROM ser GROUP BY 1)),
b AS (SELECT exchange, window_start, max_lag_s, max_lag_s IS NULL AS missing, coalesce(max_lag_s > 400.0, true) AS breach
      FROM cal LEFT JOIN ser USING (exchange, window_start))
SELECT *, CAST(sum(CAST(breach AS INTEGER)) OVER w AS BIGINT) AS breaches_in_n, sum(CAST(breach AS INTEGER)) OVER w >= 3 AS alarm
FROM b WINDOW w AS (PARTITION BY exchange ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")


@query("lag_monitor")
def q_lag_monitor(spark, sf):
    m = SV.lag_monitor(A.trades_e(spark, sf), "1 day")
    return m.withColumn("avg_lag_s", stable_round("avg_lag_s", 6))


sql("lag_monitor", with_(TRADES_E) + f""",
l AS (SELECT *, (epoch_us(ingestion_timestamp) - epoch_us("timestamp")) / 1000000 AS lag FROM trades_e)
SELECT time_bucket(INTERVAL 1 DAY, "timestamp", TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 1 DAY, "timestamp", TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end, exchange,
  count(*) AS records, max(lag) AS max_lag_s, {sround('avg(lag)', 6)} AS avg_lag_s,
  list_sort(list(lag))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS p95_lag_s
FROM l GROUP BY 1, 2, 3""")
