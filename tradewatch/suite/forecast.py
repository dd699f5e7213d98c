"""Registered queries: MOD-011 back-test and MOD-010 prediction.
Alerts to test are the whale and volume alerts of ``events``; prices are the
same trades. Horizons 1 h, 4 h, 24 h; the prediction grid has a row per symbol and 15 minutes, a
4 h outcome horizon, and scoring runs every three days."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.functions.columns import alert_id as alert_id_col
from tradewatch.functions.columns import stable_round
from tradewatch.operators import backtest as B
from tradewatch.operators import predict as P
from tradewatch.operators import wallet as W
from tradewatch.operators.windows import stored
from tradewatch.sources import adapters as A
from tradewatch.suite.core import alert_view
from tradewatch.suite.detect import VOL_SQL, vol_scored
from tradewatch.suite.identity import CONS_SQL, consensus, flows, period_sql, whales_e
from tradewatch.suite.oracle import TRADES_E, WALLET_LIVE, alert_id, sround, ttl, with_
from tradewatch.suite.registry import query, sql

HORIZONS = (3600, 14400, 86400)
BT_DATE = "2024-02-01"
PRED_H = 14400
GRID_S = 900
RUN_DAYS, MIN_RUN_TRADES = 3, 5
RUN_W = f"{RUN_DAYS} days"


def bt_alerts(spark, sf):
    wh = whales_e(spark, sf).select(
        alert_id_col(F.lit("whale_trade"), "exchange", "symbol", "event_id").alias("alert_id"),
        F.lit("MOD-002").alias("module_id"), F.lit("whale_trade").alias("alert_type"), "symbol",
        F.col("timestamp").alias("detected_at"), F.when(F.col("side") == "buy", 1).otherwise(-1).alias("direction"))
    vs = vol_scored(spark, sf).where(F.col("severity").isNotNull()).select(
        alert_id_col(F.lit("volume_spike"), "exchange", "symbol", F.unix_seconds("window_start")).alias("alert_id"),
        F.lit("MOD-001").alias("module_id"), F.lit("volume_spike").alias("alert_type"), "symbol",
        F.col("window_end").alias("detected_at"),
        F.when(F.col("close_price") > F.col("open_price"), 1).when(F.col("close_price") < F.col("open_price"), -1)
        .alias("direction"))
    return wh.unionByName(vs)


def returns(spark, sf):
    return B.bt_forward_return(bt_alerts(spark, sf), A.trades_e(spark, sf), HORIZONS)


def bt_sql(more: str = "") -> str:
    """CTEs of the back-test; ``more`` adds alerts to the whale and volume ones."""
    return VOL_SQL + f""",
wh AS (SELECT * FROM trades_e WHERE quote_volume > 100000),
alerts AS (
  SELECT {alert_id("'whale_trade'", 'exchange', 'symbol', 'event_id')} AS alert_id, 'MOD-002' AS module_id,
    'whale_trade' AS alert_type, symbol, "timestamp" AS detected_at, CASE WHEN side = 'buy' THEN 1 ELSE -1 END AS direction
  FROM wh
  UNION ALL
  SELECT {alert_id("'volume_spike'", 'exchange', 'symbol', 't')}, 'MOD-001', 'volume_spike', symbol, window_end,
    CASE WHEN close_price > open_price THEN 1 WHEN close_price < open_price THEN -1 END
  FROM vs WHERE severity IS NOT NULL{more}),
hz AS (SELECT * FROM (VALUES (3600), (14400), (86400)) t(horizon_s)),
pts AS (SELECT a.*, hz.horizon_s, a.detected_at + to_seconds(hz.horizon_s) AS t FROM alerts a, hz),
px AS (SELECT symbol, "timestamp" AS ts, arg_max(price, event_id) AS price FROM trades_e GROUP BY 1, 2),
ent AS (SELECT a.alert_id, q.price AS entry_price FROM alerts a ASOF LEFT JOIN px q
        ON a.symbol = q.symbol AND a.detected_at >= q.ts),
ex AS (SELECT p.*, q.price AS asof_price, q.ts AS asof_time FROM pts p ASOF LEFT JOIN px q
       ON p.symbol = q.symbol AND p.t >= q.ts),
r0 AS (SELECT ex.alert_id, module_id, alert_type, symbol, detected_at, direction, horizon_s, entry_price,
         CASE WHEN asof_time > detected_at THEN asof_price END AS exit_price FROM ex LEFT JOIN ent USING (alert_id)),
r AS (SELECT *, exit_price / entry_price - 1.0 AS ret, direction * (exit_price / entry_price - 1.0) AS signed_return,
        direction * (exit_price / entry_price - 1.0) > 0 AS hit FROM r0),
rc AS (SELECT *, sum(CAST(signed_return AS DECIMAL(38,12))) OVER (PARTITION BY module_id, symbol, horizon_s
         ORDER BY detected_at, alert_id ROWS UNBOUNDED PRECEDING) AS cum FROM r WHERE signed_return IS NOT NULL),
rp AS (SELECT *, greatest(CAST(0 AS DECIMAL(38,12)), max(cum) OVER (PARTITION BY module_id, symbol, horizon_s
         ORDER BY detected_at, alert_id ROWS UNBOUNDED PRECEDING)) AS peak FROM rc),
rdd AS (SELECT module_id, symbol, horizon_s, CAST(greatest(max(peak - cum), 0) AS DOUBLE) AS max_drawdown
        FROM rp GROUP BY 1, 2, 3),
rep AS (
  SELECT module_id, symbol, horizon_s, count(*) AS n_alerts, count(hit) AS n_scored,
    avg(CAST(hit AS DOUBLE)) AS hit_rate, avg(signed_return) AS avg_return,
    avg(signed_return) / stddev_samp(signed_return) AS sharpe
  FROM r GROUP BY 1, 2, 3)"""


BT_SQL = bt_sql()


@query("bt_price_asof")
def q_bt_price_asof(spark, sf):
    pts = bt_alerts(spark, sf).withColumn("t", F.col("detected_at"))
    a = B.bt_price_asof(pts, A.trades_e(spark, sf), "t")
    return a.select("alert_id", "symbol", "detected_at", "asof_price", "asof_time")


sql("bt_price_asof", with_(TRADES_E) + BT_SQL + """
SELECT a.alert_id, a.symbol, a.detected_at, q.price AS asof_price, q.ts AS asof_time
FROM alerts a ASOF LEFT JOIN px q ON a.symbol = q.symbol AND a.detected_at >= q.ts""")


@query("bt_forward_return")
def q_bt_forward_return(spark, sf):
    r = returns(spark, sf).withColumn("direction", F.col("direction").cast("double"))
    return r.select("alert_id", "module_id", "symbol", "horizon_s", "direction", "entry_price",
                                     "exit_price", "ret", "signed_return", "hit")


sql("bt_forward_return", with_(TRADES_E) + BT_SQL + """
SELECT alert_id, module_id, symbol, horizon_s, CAST(direction AS DOUBLE) AS direction, entry_price, exit_price, ret,
  signed_return, hit FROM r""")


@query("bt_hit_rate")
def q_bt_hit_rate(spark, sf):
    return B.bt_hit_rate(returns(spark, sf)).withColumn("hit_rate", stable_round("hit_rate", 6))


sql("bt_hit_rate", with_(TRADES_E) + BT_SQL + f"""
SELECT module_id, symbol, horizon_s, {sround('hit_rate', 6)} AS hit_rate, n_scored FROM rep""")


@query("bt_avg_return")
def q_bt_avg_return(spark, sf):
    return B.bt_avg_return(returns(spark, sf)).withColumn("avg_return", stable_round("avg_return", 8))


sql("bt_avg_return", with_(TRADES_E) + BT_SQL + f"""
SELECT module_id, symbol, horizon_s, {sround('avg_return', 8)} AS avg_return FROM rep""")


@query("bt_sharpe")
def q_bt_sharpe(spark, sf):
    return B.bt_sharpe(returns(spark, sf)).withColumn("sharpe", stable_round("sharpe", 6))


sql("bt_sharpe", with_(TRADES_E) + BT_SQL + f"""
SELECT module_id, symbol, horizon_s, {sround('sharpe', 6)} AS sharpe FROM rep""")


@query("bt_max_drawdown")
def q_bt_max_drawdown(spark, sf):
    return B.bt_max_drawdown(returns(spark, sf)).withColumn("max_drawdown", stable_round("max_drawdown", 8))


sql("bt_max_drawdown", with_(TRADES_E) + BT_SQL + f"""
SELECT module_id, symbol, horizon_s, {sround('max_drawdown', 8)} AS max_drawdown FROM rdd""")


@query("bt_report")
def q_bt_report(spark, sf):
    rep = B.bt_report(returns(spark, sf), BT_DATE)
    return rep.select("module_id", "symbol", "horizon_s", "n_alerts", "n_scored",
                      stable_round("hit_rate", 6).alias("hit_rate"), stable_round("avg_return", 8).alias("avg_return"),
                      stable_round("sharpe", 6).alias("sharpe"), stable_round("max_drawdown", 8).alias("max_drawdown"),
                      F.date_format("backtest_date", "yyyy-MM-dd").alias("backtest_date"))


sql("bt_report", with_(TRADES_E) + BT_SQL + f"""
SELECT module_id, symbol, horizon_s, n_alerts, n_scored, {sround('hit_rate', 6)} AS hit_rate,
  {sround('avg_return', 8)} AS avg_return, {sround('sharpe', 6)} AS sharpe, {sround('max_drawdown', 8)} AS max_drawdown,
  '{BT_DATE}' AS backtest_date
FROM rep LEFT JOIN rdd USING (module_id, symbol, horizon_s)""")


@query("backtest_complete")
def q_backtest_complete(spark, sf):
    a = alert_view(B.bt_complete_alerts(B.bt_report(returns(spark, sf), BT_DATE)),
                   {"tested_module": "string", "n_alerts": "long", "mean_hit_rate": "double"})
    return a.withColumn("d_mean_hit_rate", stable_round("d_mean_hit_rate", 6))


COMPLETE_SQL = f""",
g AS (SELECT module_id AS tested, CAST(sum(n_alerts) AS BIGINT) AS n, avg(hit_rate) AS h, TIMESTAMP '{BT_DATE}' AS tm FROM rep GROUP BY 1)
SELECT {alert_id("'backtest_complete'", 'NULL', 'NULL', 'tested', f"'{BT_DATE}'")} AS alert_id, 'backtest_complete' AS alert_type,
  'MOD-011' AS module_id, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS exchange, 'low' AS severity, tm AS detected_at,
  'Back-test of ' || tested || ' complete: ' || n || ' alerts' AS message, {ttl('tm')} AS ttl_epoch,
  tested AS d_tested_module, n AS d_n_alerts, {sround('h', 6)} AS d_mean_hit_rate FROM g"""

sql("backtest_complete", with_(TRADES_E) + BT_SQL + COMPLETE_SQL)


@query("bt_degradation")
def q_bt_degradation(spark, sf):
    a = alert_view(B.bt_degradation(B.bt_daily_hit_rate(returns(spark, sf))),
                   {"tested_module": "string", "horizon_s": "long", "hit_rate": "double"})
    return a.withColumn("d_hit_rate", stable_round("d_hit_rate", 6))


DEGRADATION_SQL = f""",
dly AS (SELECT module_id, symbol, horizon_s, CAST(detected_at AS DATE) AS backtest_date,
          avg(CAST(hit AS DOUBLE)) AS hit_rate FROM r GROUP BY 1, 2, 3, 4),
tr AS (SELECT *, avg(hit_rate) OVER (PARTITION BY module_id, symbol, horizon_s ORDER BY backtest_date
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS trailing_rate FROM dly)
SELECT {alert_id("'signal_degradation'", 'NULL', 'symbol', 'module_id', 'horizon_s', 'backtest_date')} AS alert_id,
  'signal_degradation' AS alert_type, 'MOD-011' AS module_id, symbol, CAST(NULL AS VARCHAR) AS exchange,
  'high' AS severity, CAST(backtest_date AS TIMESTAMP) AS detected_at,
  'Hit rate of ' || module_id || ' on ' || symbol || ' fell below its trailing mean' AS message,
  {ttl('CAST(backtest_date AS TIMESTAMP)')} AS ttl_epoch, module_id AS d_tested_module, horizon_s AS d_horizon_s,
  {sround('hit_rate', 6)} AS d_hit_rate
FROM tr WHERE hit_rate < trailing_rate - 0.1"""

sql("bt_degradation", with_(TRADES_E) + BT_SQL + DEGRADATION_SQL)


# ---- MOD-010 ------------------------------------------------------------------------------------

def symbol_alpha(spark, sf):
    """Alpha percentile of a symbol's wallets at every scoring run."""
    return W.alpha_by_symbol(W.alpha_percentile(W.wallet_scores_periodic(A.wallet_trades_live(spark, sf), RUN_W, MIN_RUN_TRADES, symbols=True)))


def features(spark, sf):
    """Stored: outcomes and accuracy read the grid as well."""
    t = A.trades_e(spark, sf)
    f = P.pred_features(P.pred_grid(t, GRID_S), consensus(spark, sf), vol_scored(spark, sf), flows(spark, sf), symbol_alpha(spark, sf))
    return stored(f, "features")


def accuracy(spark, sf):
    f = features(spark, sf)
    out = P.pred_outcomes(f, A.trades_e(spark, sf), PRED_H)
    return P.pred_accuracy(f, out, PRED_H, GRID_S)


ALPHA_SQL = "," + period_sql("wallet_live", RUN_DAYS, MIN_RUN_TRADES) + """,
lpr AS (SELECT wallet, blockchain, period_start, scored_at, percent_rank() OVER (PARTITION BY blockchain, scored_at ORDER BY alpha) AS q
  FROM ys WHERE alpha IS NOT NULL),
la AS (SELECT symbol, scored_at, CAST(sum(CAST(q AS DECIMAL(20,12))) AS DOUBLE) / count(*) AS alpha_pct
  FROM (SELECT DISTINCT wallet, blockchain, period_start, symbol FROM y) JOIN lpr USING (wallet, blockchain, period_start) GROUP BY 1, 2)"""

PRED_SQL = CONS_SQL + ALPHA_SQL + f""",
grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL {GRID_S} SECOND)) AS window_start FROM (
  SELECT symbol, time_bucket(INTERVAL {GRID_S} SECOND, min("timestamp"), TIMESTAMP '1970-01-01') AS lo,
    time_bucket(INTERVAL {GRID_S} SECOND, max("timestamp"), TIMESTAMP '1970-01-01') AS hi FROM trades_e GROUP BY 1)),
g0 AS (SELECT symbol, window_start, window_start + INTERVAL {GRID_S} SECOND AS window_end FROM grid),
zz AS (SELECT symbol, window_end AS at, max(abs(z_score)) AS z FROM vs WHERE z_score IS NOT NULL GROUP BY 1, 2),
g1 AS (SELECT g.*, c.consensus_score AS c FROM g0 g ASOF LEFT JOIN cscore c ON g.symbol = c.symbol AND g.window_end >= c.window_end),
g2 AS (SELECT g.*, zz.z FROM g1 g ASOF LEFT JOIN zz ON g.symbol = zz.symbol AND g.window_end >= zz.at),
g3 AS (SELECT g.*, f.flow_ratio AS f FROM g2 g ASOF LEFT JOIN (SELECT * FROM fl WHERE flow_ratio IS NOT NULL) f
  ON g.symbol = f.symbol AND g.window_end >= f.window_end),
g4 AS (SELECT g.*, la.alpha_pct AS a FROM g3 g ASOF LEFT JOIN la ON g.symbol = la.symbol AND g.window_end >= la.scored_at),
pf AS (SELECT symbol, window_start, window_end, coalesce(c, 0.0) AS consensus_score, coalesce(z, 0.0) AS z_score, coalesce(f, 0.5) AS flow_ratio,
    coalesce(a, 0.5) AS alpha_pct, least(coalesce(z, 0.0) / 3.5, 1.0) AS volume_signal, abs(2.0 * coalesce(f, 0.5) - 1.0) AS flow_signal FROM g4),
px AS (SELECT symbol, "timestamp" AS ts, arg_max(price, event_id) AS price FROM trades_e GROUP BY 1, 2),
o0 AS (SELECT p.window_start, p.symbol, p.window_end, q.price AS close_0 FROM pf p ASOF LEFT JOIN px q
       ON p.symbol = q.symbol AND p.window_end >= q.ts),
o1 AS (SELECT p.window_start, p.symbol, q.price AS close_h, q.ts AS time_h FROM pf p ASOF LEFT JOIN px q
       ON p.symbol = q.symbol AND p.window_end + INTERVAL {PRED_H} SECOND >= q.ts),
oc AS (SELECT o0.window_start, o0.symbol, CASE WHEN time_h > window_end THEN abs(close_h / close_0 - 1.0) > 0.02 END AS moved
       FROM o0 JOIN o1 USING (window_start, symbol)),
pa AS (
  SELECT pf.*, oc.moved, CAST(floor(consensus_score / 20) AS INTEGER) AS score_bucket,
    CAST(floor(flow_ratio * 5) AS INTEGER) AS flow_bucket, epoch_us(pf.window_start) // 1000000 AS t
  FROM pf LEFT JOIN oc USING (window_start, symbol)),
acc AS (SELECT *, avg(CAST(moved AS DOUBLE)) OVER (PARTITION BY score_bucket, flow_bucket ORDER BY t
          RANGE BETWEEN UNBOUNDED PRECEDING AND {GRID_S + PRED_H} PRECEDING) AS accuracy FROM pa),
{",".join(
    f'''x_{n} AS (SELECT window_start, symbol, CAST({b0} AS DOUBLE) + CAST({b1} AS DOUBLE) * consensus_score / 100.0
      + CAST({b2} AS DOUBLE) * alpha_pct + CAST({b3} AS DOUBLE) * volume_signal + CAST({b4} AS DOUBLE) * flow_signal
      + CAST({b5} AS DOUBLE) * coalesce(accuracy, 0.5) AS x FROM acc)'''
    for n, (b0, b1, b2, b3, b4, b5) in P.COEFFICIENTS.items())},
ps AS (
  SELECT acc.*, 1.0 / (1.0 + exp(-x_p_1h.x)) AS p_1h, 1.0 / (1.0 + exp(-x_p_2h.x)) AS p_2h,
    1.0 / (1.0 + exp(-x_p_4h.x)) AS p_4h
  FROM acc JOIN x_p_1h USING (window_start, symbol) JOIN x_p_2h USING (window_start, symbol)
    JOIN x_p_4h USING (window_start, symbol))"""


@query("pred_features")
def q_pred_features(spark, sf):
    f = features(spark, sf)
    return f.select("window_start", "symbol", *[stable_round(c, 6).alias(c) for c in ("consensus_score", "z_score", "flow_ratio", "alpha_pct")])


sql("pred_features", with_(TRADES_E, WALLET_LIVE) + VOL_SQL + PRED_SQL + f"""
SELECT window_start, symbol, {sround('consensus_score', 6)} AS consensus_score, {sround('z_score', 6)} AS z_score,
  {sround('flow_ratio', 6)} AS flow_ratio, {sround('alpha_pct', 6)} AS alpha_pct FROM pf""")


@query("pred_accuracy")
def q_pred_accuracy(spark, sf):
    a = accuracy(spark, sf)
    return a.select("window_start", "symbol", "moved", "score_bucket", "flow_bucket",
                    stable_round("accuracy", 6).alias("accuracy"))


sql("pred_accuracy", with_(TRADES_E, WALLET_LIVE) + VOL_SQL + PRED_SQL + f"""
SELECT window_start, symbol, moved, score_bucket, flow_bucket, {sround('accuracy', 6)} AS accuracy FROM acc""")


@query("pred_score")
def q_pred_score(spark, sf):
    s = P.pred_score(accuracy(spark, sf))
    return s.select("window_start", "symbol", *[stable_round(c, 6).alias(c) for c in ("p_1h", "p_2h", "p_4h")])


sql("pred_score", with_(TRADES_E, WALLET_LIVE) + VOL_SQL + PRED_SQL + f"""
SELECT window_start, symbol, {sround('p_1h', 6)} AS p_1h, {sround('p_2h', 6)} AS p_2h, {sround('p_4h', 6)} AS p_4h
FROM ps""")


@query("pred_alerts")
def q_pred_alerts(spark, sf):
    a = alert_view(P.pred_alerts(P.pred_score(accuracy(spark, sf))), {"p_1h": "double"})
    return a.withColumn("d_p_1h", stable_round("d_p_1h", 6))


sql("pred_alerts", with_(TRADES_E, WALLET_LIVE) + VOL_SQL + PRED_SQL + f""",
pl AS (SELECT *, lag(p_1h) OVER (PARTITION BY symbol ORDER BY window_start) AS prev_p_1h FROM ps)
SELECT {alert_id("'high_probability_move'", 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')} AS alert_id,
  'high_probability_move' AS alert_type, 'MOD-010' AS module_id, symbol, CAST(NULL AS VARCHAR) AS exchange,
  'high' AS severity, window_end AS detected_at, 'Move over 2 % likely on ' || symbol AS message,
  {ttl('window_end')} AS ttl_epoch, {sround('p_1h', 6)} AS d_p_1h FROM ps WHERE p_1h > 0.7
UNION ALL
SELECT {alert_id("'score_update'", 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')}, 'score_update', 'MOD-010',
  symbol, NULL, 'low', window_end, 'Score update on ' || symbol, {ttl('window_end')}, {sround('p_1h', 6)}
FROM pl WHERE abs(p_1h - prev_p_1h) > 0.1""")
