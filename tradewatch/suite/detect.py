"""Registered queries: MOD-001 volume and MOD-003 spread.

Test window sizes follow FIXTURES.md 4.4 (the 30 s to 60 s defaults are too
fine for the test data): 1 h windows, 72 h baseline of at least 5 windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.operators import lineage as L
from tradewatch.operators import spread as S
from tradewatch.operators import volume as V
from tradewatch.sources import adapters as A
from tradewatch.suite.core import ALERT_BASE, alert_view
from tradewatch.functions.columns import stable_round
from tradewatch.suite.oracle import TRADES_E, alert_id, sround, ttl, with_
from tradewatch.suite.registry import PROCESSED_AT, query, sql

CFG = make_config({"volume_anomaly": {"window_seconds": 3600, "rolling_window_seconds": 259200},
                   "spread_calculator": {"window_seconds": 3600}})
VOL_W, VOL_LB = "1 hour", 259200
SPREAD_W = "1 hour"


def vol_scored(spark, sf):
    return V.vol_detect(A.trades_e(spark, sf), CFG, VOL_W, VOL_LB)


def vol_alerts(spark, sf):
    s = vol_scored(spark, sf)
    s = L.lin_attach(s, "MOD-001", "volume-anomaly", CFG["volume_anomaly"], PROCESSED_AT, event_col="last_event_id")
    return V.vol_spike_alerts(s, CFG)


def spreads(spark, sf):
    return S.spread_detect(A.trades_e(spark, sf), CFG, SPREAD_W)


def spread_alerts(spark, sf):
    c = CFG["spread_calculator"]
    s = L.lin_attach_latest(spreads(spark, sf), "MOD-003", "spread-calculator", c, PROCESSED_AT)
    return S.spread_alerts(s, c["spread_threshold_pct"], c["spread_high_pct"])


STRUCT_ORDER = 'struct_pack(t := "timestamp", e := event_id)'
VOL_SQL = f""",
vagg AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start, symbol, exchange,
    CAST(SUM(CAST(quote_volume AS DECIMAL(28,8))) AS DOUBLE) AS window_volume, count(*) AS trade_count,
    max_by(event_id, {STRUCT_ORDER}) AS last_event_id, max("timestamp") AS last_timestamp,
    min_by(price, {STRUCT_ORDER}) AS open_price, max_by(price, {STRUCT_ORDER}) AS close_price
  FROM trades_e GROUP BY 1, 2, 3),
vbase AS (
  SELECT *, window_start + INTERVAL 1 HOUR AS window_end, epoch_us(window_start) // 1000000 AS t FROM vagg),
vroll AS (
  SELECT *, count(*) OVER w AS n_prev,
    CAST(SUM(CAST(window_volume AS DECIMAL(28,8))) OVER w AS DOUBLE) / count(*) OVER w AS mean0,
    stddev_samp(window_volume) OVER w AS sd0
  FROM vbase WINDOW w AS (PARTITION BY symbol, exchange ORDER BY t RANGE BETWEEN {VOL_LB} PRECEDING AND 1 PRECEDING)),
vb AS (
  SELECT *, CASE WHEN n_prev >= 5 THEN mean0 END AS rolling_mean, CASE WHEN n_prev >= 5 THEN sd0 END AS rolling_stddev
  FROM vroll),
vz AS (
  SELECT *, CASE WHEN rolling_stddev > 0 THEN (window_volume - rolling_mean) / rolling_stddev END AS z_score FROM vb),
vs AS (
  SELECT *, CASE WHEN abs(z_score) > 3.5 THEN 'high' WHEN abs(z_score) > 2.5 THEN 'medium' END AS severity,
    CASE WHEN z_score > 0 THEN 'up' WHEN z_score < 0 THEN 'down' END AS direction FROM vz)"""


@query("vol_aggregate")
def q_vol_aggregate(spark, sf):
    a = V.vol_aggregate(A.trades_e(spark, sf), VOL_W)
    return a.select("window_start", "window_end", "symbol", "exchange", "window_volume",
                    "trade_count", "last_event_id", "open_price", "close_price", "correlation_id")


sql("vol_aggregate", with_(TRADES_E) + VOL_SQL + f"""
SELECT window_start, window_end, symbol, exchange, window_volume, trade_count, last_event_id,
  open_price, close_price, substr(sha256(concat_ws(':', exchange, symbol,
    strftime(last_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')), 1, 16) AS correlation_id
FROM vbase""")

ROLL_COLS = ["window_start", "symbol", "exchange", "n_prev"]


@query("vol_baseline")
def q_vol_baseline(spark, sf):
    b = V.vol_baseline(V.vol_aggregate(A.trades_e(spark, sf), VOL_W), VOL_LB, 5)
    # the mean is exact (decimal sum / n); the floating stddev is shown to cents
    return b.select(*ROLL_COLS, "window_volume", stable_round("rolling_mean", 4).alias("rolling_mean"),
                    F.round("rolling_stddev", 2).alias("rolling_stddev"))


sql("vol_baseline", with_(TRADES_E) + VOL_SQL + f"""
SELECT window_start, symbol, exchange, n_prev, window_volume,
  {sround('rolling_mean', 4)} AS rolling_mean, round(rolling_stddev, 2) AS rolling_stddev FROM vb""")


@query("vol_zscore")
def q_vol_zscore(spark, sf):
    z = vol_scored(spark, sf)
    return z.select("window_start", "symbol", "exchange", F.round("z_score", 6).alias("z_score"), "severity",
                    "direction")


sql("vol_zscore", with_(TRADES_E) + VOL_SQL + """
SELECT window_start, symbol, exchange, round(z_score, 6) AS z_score, severity, direction FROM vs""")

VOL_FIELDS = {"z_score": "double", "direction": "string", "trade_count": "long", "_lineage.source_event_id": "string"}


@query("vol_spike_alerts")
def q_vol_spike_alerts(spark, sf):
    v = alert_view(vol_alerts(spark, sf), VOL_FIELDS)
    return v.withColumn("d_z_score", F.round("d_z_score", 6))


VOL_ALERTS_SQL = f""",
vol_alerts AS (
  SELECT {alert_id("'volume_spike'", 'exchange', 'symbol', 't')} AS alert_id, 'volume_spike' AS alert_type,
    'MOD-001' AS module_id, symbol, exchange, severity, window_end AS detected_at,
    printf('Volume %s on %s %s: %d USD in window', direction, exchange, symbol, CAST(floor(window_volume) AS BIGINT))
      AS message, {ttl('window_end')} AS ttl_epoch, round(z_score, 6) AS d_z_score, direction AS d_direction,
    trade_count AS d_trade_count, last_event_id AS d_source_event_id, z_score, window_start, window_end, direction,
    last_event_id,
    substr(sha256(concat_ws(':', exchange, symbol, strftime(last_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')), 1, 16)
      AS correlation_id
  FROM vs WHERE severity IS NOT NULL)"""

sql("vol_spike_alerts", with_(TRADES_E) + VOL_SQL + VOL_ALERTS_SQL + f"""
SELECT {ALERT_BASE}, d_z_score, d_direction, d_trade_count, d_source_event_id FROM vol_alerts""")

SPREAD_SQL = """,
vw AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start, symbol, exchange,
    CAST(SUM(CAST(price * quantity AS DECIMAL(28,8))) AS DOUBLE) / CAST(SUM(CAST(quantity AS DECIMAL(28,8))) AS DOUBLE)
      AS vwap, count(*) AS trade_count
  FROM trades_e GROUP BY 1, 2, 3),
sp0 AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, symbol, exchange AS exchange_a,
    lead(exchange) OVER w AS exchange_b, vwap AS vwap_a, lead(vwap) OVER w AS vwap_b
  FROM vw WINDOW w AS (PARTITION BY window_start, symbol ORDER BY exchange)),
sp AS (
  SELECT *, (vwap_a - vwap_b) / vwap_b * 100.0 AS spread_pct FROM sp0 WHERE exchange_b IS NOT NULL)"""


@query("vwap")
def q_vwap(spark, sf):
    v = S.vwap(A.trades_e(spark, sf), SPREAD_W)
    return v.select("window_start", "window_end", "symbol", "exchange", F.round("vwap", 6).alias("vwap"), "trade_count")


sql("vwap", with_(TRADES_E) + SPREAD_SQL + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, symbol, exchange, round(vwap, 6) AS vwap, trade_count
FROM vw""")


@query("spread")
def q_spread(spark, sf):
    s = spreads(spark, sf)
    return s.select("window_start", "window_end", "symbol", "exchange_a", "exchange_b", F.round("vwap_a", 6).alias("vwap_a"),
                    F.round("vwap_b", 6).alias("vwap_b"), F.round("spread_pct", 6).alias("spread_pct"))


sql("spread", with_(TRADES_E) + SPREAD_SQL + """
SELECT window_start, window_end, symbol, exchange_a, exchange_b, round(vwap_a, 6) AS vwap_a, round(vwap_b, 6) AS vwap_b,
  round(spread_pct, 6) AS spread_pct FROM sp""")

SPREAD_FIELDS = {"spread_pct": "double", "exchange_a": "string", "exchange_b": "string"}


@query("spread_alerts")
def q_spread_alerts(spark, sf):
    v = alert_view(spread_alerts(spark, sf), SPREAD_FIELDS)
    return v.withColumn("d_spread_pct", F.round("d_spread_pct", 6))


SPREAD_ALERTS_SQL = f""",
lastev AS (
  SELECT time_bucket(INTERVAL 1 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start, symbol,
    arg_max(struct_pack(t := "timestamp", x := exchange, e := event_id), struct_pack(t := "timestamp", x := exchange, e := event_id)) AS l
  FROM trades_e GROUP BY 1, 2),
spread_alerts AS (
  SELECT {alert_id("'spread_divergence'", 'NULL', 'symbol', 'epoch_us(window_start) // 1000000', 'exchange_a',
                   'exchange_b')} AS alert_id,
    'spread_divergence' AS alert_type, 'MOD-003' AS module_id, symbol, CAST(NULL AS VARCHAR) AS exchange,
    CASE WHEN abs(spread_pct) > 1.0 THEN 'high' ELSE 'medium' END AS severity, window_end AS detected_at,
    'Spread between ' || exchange_a || ' and ' || exchange_b || ' on ' || symbol || ' over 0.5 %' AS message,
    {ttl('window_end')} AS ttl_epoch, round(spread_pct, 6) AS d_spread_pct, exchange_a AS d_exchange_a,
    exchange_b AS d_exchange_b, spread_pct, window_start, exchange_a, exchange_b, l.e AS last_event_id,
    substr(sha256(concat_ws(':', l.x, symbol, strftime(l.t, '%Y-%m-%dT%H:%M:%S.%g') || 'Z')), 1, 16) AS correlation_id
  FROM sp JOIN lastev USING (window_start, symbol) WHERE abs(spread_pct) > 0.5)"""

sql("spread_alerts", with_(TRADES_E) + SPREAD_SQL + SPREAD_ALERTS_SQL + f"""
SELECT {ALERT_BASE}, d_spread_pct, d_exchange_a, d_exchange_b FROM spread_alerts""")
