"""Registered queries: MOD-004 to MOD-007.

Wallets come from lineitem x orders (FIXTURES 4.3); scoring covers the whole
history (``DAYS`` spans every ship date) so each query reads all rows. Flow
and consensus use 6 h windows (FIXTURES 4.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.functions.columns import alert_id as alert_id_col
from tradewatch.functions.columns import stable_round
from tradewatch.operators import flow as FL
from tradewatch.operators import labels as LB
from tradewatch.operators import wallet as W
from tradewatch.operators.whale import whale_detect
from tradewatch.sources import adapters as A
from tradewatch.suite.core import alert_view
from tradewatch.suite.detect import CFG, VOL_ALERTS_SQL, VOL_SQL, vol_scored
from tradewatch.suite.oracle import (
    TRADES_E, WALLET_LABELS, WALLET_TRADES, alert_id, sround, ttl, with_,
)
from tradewatch.suite.registry import query, sql

DAYS = 5000
MIN_TRADES = 5
PERIOD = "365 days"
PERIOD_MIN_TRADES = 3
SCORE_DELTA = 0.2
FLOW_W = "6 hours"


def wallet_scores_all(spark, sf):
    # every trade has an order, so the clock can be read before the join
    clock = A.trades_l(spark, sf).agg(F.max("timestamp")).scalar()
    return W.wallet_scores(A.wallet_trades(spark, sf), clock, DAYS, MIN_TRADES)


def wallet_scores_yearly(spark, sf):
    return W.wallet_scores_periodic(A.wallet_trades(spark, sf), PERIOD, PERIOD_MIN_TRADES)


WT = WALLET_TRADES + f""",
wt AS (SELECT w.*, m.as_of FROM wallet_trades w, (SELECT max(ts) AS as_of FROM wallet_trades) m),
r AS (SELECT * FROM wt WHERE ts > make_timestamp(epoch_us(as_of) - CAST({DAYS} AS BIGINT) * 86400 * 1000000) AND ts <= as_of),
st AS (
  SELECT wallet, blockchain, max(as_of) AS scored_at, count(*) AS trade_count, count(*) FILTER (WHERE ret > 0) AS wins,
    count(*) FILTER (WHERE ret > 0) / count(*) AS win_rate,
    CAST(sum(CAST(ret AS DECIMAL(18,8))) AS DOUBLE) / count(*) AS avg_return
  FROM r GROUP BY 1, 2),
c AS (
  SELECT wallet, blockchain, ts, event_id, sum(CAST(ret AS DECIMAL(38,12))) OVER (PARTITION BY wallet, blockchain
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum FROM r),
p AS (
  SELECT *, greatest(CAST(0 AS DECIMAL(38,12)), max(cum) OVER (PARTITION BY wallet, blockchain
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) AS peak FROM c),
dd AS (
  SELECT wallet, blockchain, CAST(greatest(max(peak - cum), 0) AS DOUBLE) AS max_drawdown FROM p GROUP BY 1, 2),
sc AS (
  SELECT st.*, dd.max_drawdown,
    CASE WHEN trade_count >= {MIN_TRADES} AND max_drawdown <> 0
      THEN win_rate * avg_return * sqrt(trade_count) / max_drawdown END AS alpha
  FROM st LEFT JOIN dd USING (wallet, blockchain))"""

def period_sql(source: str, days: int, min_trades: int) -> str:
    """Scores per scoring period, the CTE ``ys``."""
    return f"""
y AS (SELECT *, time_bucket(INTERVAL {days} DAY, ts, TIMESTAMP '1970-01-01') AS period_start FROM {source}),
yst AS (
  SELECT wallet, blockchain, period_start, period_start + INTERVAL {days} DAY AS scored_at, count(*) AS trade_count,
    count(*) FILTER (WHERE ret > 0) / count(*) AS win_rate,
    CAST(sum(CAST(ret AS DECIMAL(18,8))) AS DOUBLE) / count(*) AS avg_return
  FROM y GROUP BY 1, 2, 3),
yc AS (
  SELECT wallet, blockchain, period_start, ts, event_id, sum(CAST(ret AS DECIMAL(38,12))) OVER (
    PARTITION BY wallet, blockchain, period_start ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum FROM y),
yp AS (
  SELECT *, greatest(CAST(0 AS DECIMAL(38,12)), max(cum) OVER (PARTITION BY wallet, blockchain, period_start
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) AS peak FROM yc),
ydd AS (
  SELECT wallet, blockchain, period_start, CAST(greatest(max(peak - cum), 0) AS DOUBLE) AS max_drawdown
  FROM yp GROUP BY 1, 2, 3),
ys AS (
  SELECT yst.*, ydd.max_drawdown,
    CASE WHEN trade_count >= {min_trades} AND max_drawdown <> 0
      THEN win_rate * avg_return * sqrt(trade_count) / max_drawdown END AS alpha
  FROM yst LEFT JOIN ydd USING (wallet, blockchain, period_start))"""


YEARLY = WALLET_TRADES + "," + period_sql("wallet_trades", 365, PERIOD_MIN_TRADES)


@query("wallet_stats")
def q_wallet_stats(spark, sf):
    s = W.wallet_stats(A.wallet_trades(spark, sf), None, DAYS)
    return s.select("wallet", "blockchain", "scored_at", "trade_count", "wins", stable_round("win_rate", 6).alias("win_rate"),
                    stable_round("avg_return", 8).alias("avg_return"))


sql("wallet_stats", with_(WT) + f"""
SELECT wallet, blockchain, scored_at, trade_count, wins, {sround('win_rate', 6)} AS win_rate,
  {sround('avg_return', 8)} AS avg_return FROM st""")


@query("wallet_drawdown")
def q_wallet_drawdown(spark, sf):
    d = W.wallet_drawdown(A.wallet_trades(spark, sf), None, DAYS)
    return d.select("wallet", "blockchain", stable_round("max_drawdown", 8).alias("max_drawdown"))


sql("wallet_drawdown", with_(WT) + f"SELECT wallet, blockchain, {sround('max_drawdown', 8)} AS max_drawdown FROM dd")


@query("wallet_alpha")
def q_wallet_alpha(spark, sf):
    s = wallet_scores_all(spark, sf)
    return s.select("wallet", "blockchain", "trade_count", stable_round("alpha", 6).alias("alpha"))


sql("wallet_alpha", with_(WT) + f"SELECT wallet, blockchain, trade_count, {sround('alpha', 6)} AS alpha FROM sc")


@query("alpha_percentile")
def q_alpha_percentile(spark, sf):
    p = W.alpha_percentile(wallet_scores_yearly(spark, sf))
    return p.select("wallet", "blockchain", "scored_at", stable_round("alpha_percentile", 6).alias("alpha_percentile"))


sql("alpha_percentile", with_(YEARLY) + f""",
pr AS (SELECT wallet, blockchain, scored_at, percent_rank() OVER (PARTITION BY blockchain, scored_at ORDER BY alpha) AS q
       FROM ys WHERE alpha IS NOT NULL)
SELECT ys.wallet, ys.blockchain, ys.scored_at, {sround('pr.q', 6)} AS alpha_percentile
FROM ys LEFT JOIN pr USING (wallet, blockchain, scored_at)""")

HIGH_FIELDS = {"wallet": "string", "alpha": "double", "threshold": "double"}


@query("wallet_high_alpha")
def q_wallet_high_alpha(spark, sf):
    a = alert_view(W.wallet_high_alpha(wallet_scores_yearly(spark, sf)), HIGH_FIELDS)
    return a.withColumn("d_alpha", stable_round("d_alpha", 6)).withColumn("d_threshold", stable_round("d_threshold", 6))


HIGH_SQL = f""",
ranked AS (SELECT scored_at, alpha, row_number() OVER (PARTITION BY scored_at ORDER BY alpha) AS rn,
           count(*) OVER (PARTITION BY scored_at) AS n FROM ys WHERE alpha IS NOT NULL),
th AS (SELECT scored_at, max(alpha) FILTER (WHERE rn = CAST(ceil(0.95 * n) AS BIGINT)) AS threshold,
              max(alpha) FILTER (WHERE rn = CAST(ceil(0.99 * n) AS BIGINT)) AS high_threshold FROM ranked GROUP BY 1),
h AS (SELECT ys.*, th.threshold, th.high_threshold FROM ys JOIN th USING (scored_at) WHERE alpha > threshold)
SELECT {alert_id("'high_alpha_wallet'", 'NULL', 'NULL', 'wallet', 'blockchain', 'epoch_us(scored_at) // 1000000')}
    AS alert_id, 'high_alpha_wallet' AS alert_type, 'MOD-004' AS module_id, CAST(NULL AS VARCHAR) AS symbol,
  CAST(NULL AS VARCHAR) AS exchange, CASE WHEN alpha > high_threshold THEN 'high' ELSE 'medium' END AS severity,
  scored_at AS detected_at,
  'Wallet ' || wallet || ' on ' || blockchain || ' above the 95 percentile of alpha' AS message,
  {ttl('scored_at')} AS ttl_epoch, CAST(wallet AS VARCHAR) AS d_wallet, {sround('alpha', 6)} AS d_alpha,
  {sround('threshold', 6)} AS d_threshold
FROM h"""

sql("wallet_high_alpha", with_(YEARLY) + HIGH_SQL)

CHANGE_FIELDS = {"wallet": "string", "alpha": "double", "prev_alpha": "double"}


@query("wallet_score_change")
def q_wallet_score_change(spark, sf):
    a = alert_view(W.wallet_score_change(wallet_scores_yearly(spark, sf), SCORE_DELTA), CHANGE_FIELDS)
    return a.withColumn("d_alpha", stable_round("d_alpha", 6)).withColumn("d_prev_alpha", stable_round("d_prev_alpha", 6))


CHANGE_SQL = f""",
l AS (SELECT *, lag(alpha) OVER (PARTITION BY wallet, blockchain ORDER BY scored_at) AS prev_alpha FROM ys)
SELECT {alert_id("'score_change'", 'NULL', 'NULL', 'wallet', 'blockchain', 'epoch_us(scored_at) // 1000000')}
    AS alert_id, 'score_change' AS alert_type, 'MOD-004' AS module_id, CAST(NULL AS VARCHAR) AS symbol,
  CAST(NULL AS VARCHAR) AS exchange, 'low' AS severity, scored_at AS detected_at,
  'Wallet ' || wallet || ' alpha moved by more than {SCORE_DELTA}' AS message, {ttl('scored_at')} AS ttl_epoch,
  CAST(wallet AS VARCHAR) AS d_wallet, {sround('alpha', 6)} AS d_alpha, {sround('prev_alpha', 6)} AS d_prev_alpha
FROM l WHERE abs(alpha - prev_alpha) > {SCORE_DELTA}"""

sql("wallet_score_change", with_(YEARLY) + CHANGE_SQL)


# ---- MOD-005 -----------------------------------------------------------------------------------

def labels_new(spark, sf):
    cu = A.table(spark, sf, "customer")
    return cu.where(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.col("c_custkey").alias("wallet"), F.concat(F.col("c_name"), F.lit("-v2")).alias("label"),
        F.col("c_mktsegment").alias("entity_type"))


@query("label_refresh")
def q_label_refresh(spark, sf):
    return LB.label_refresh(A.wallet_labels(spark, sf), labels_new(spark, sf))


sql("label_refresh", with_(WALLET_LABELS) + """,
nw AS (SELECT c_custkey AS wallet, c_name || '-v2' AS label, c_mktsegment AS entity_type FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD'))
SELECT coalesce(n.wallet, o.wallet) AS wallet, coalesce(n.label, o.label) AS label,
  coalesce(n.entity_type, o.entity_type) AS entity_type,
  CASE WHEN n.label IS NULL THEN 'kept' WHEN o.label IS NULL THEN 'added' WHEN o.label = n.label THEN 'unchanged'
       ELSE 'updated' END AS change
FROM wallet_labels o FULL OUTER JOIN nw n ON o.wallet = n.wallet""")


@query("label_enrich")
def q_label_enrich(spark, sf):
    e = LB.label_enrich(A.wallet_trades(spark, sf), A.wallet_labels(spark, sf))
    return e.select("event_id", "wallet", "label", "entity_type")


sql("label_enrich", with_(WALLET_TRADES, WALLET_LABELS) + """
SELECT event_id, t.wallet, label, entity_type FROM wallet_trades t LEFT JOIN wallet_labels l ON t.wallet = l.wallet""")

LABEL_FIELDS = {"wallet": "string", "label": "string", "quote_volume": "double"}


@query("label_alerts")
def q_label_alerts(spark, sf):
    t = A.wallet_trades(spark, sf).withColumn("timestamp", F.col("ts"))
    return alert_view(LB.label_alerts(t, A.wallet_labels(spark, sf)), LABEL_FIELDS)



LABEL_SQL = f"""
SELECT {alert_id("'known_whale_activity'", 'exchange', 'symbol', 'event_id', 't.wallet')} AS alert_id,
  'known_whale_activity' AS alert_type, 'MOD-005' AS module_id, symbol, exchange,
  CASE WHEN quote_volume > 500000 THEN 'high' ELSE 'medium' END AS severity, ts AS detected_at,
  printf('Labelled wallet %s (%s) traded %d USD of %s', CAST(t.wallet AS VARCHAR), label,
         CAST(floor(quote_volume) AS BIGINT), symbol) AS message,
  {ttl('ts')} AS ttl_epoch, CAST(t.wallet AS VARCHAR) AS d_wallet, label AS d_label, quote_volume AS d_quote_volume
FROM wallet_trades t JOIN wallet_labels l ON t.wallet = l.wallet WHERE quote_volume > 100000"""

sql("label_alerts", with_(WALLET_TRADES, WALLET_LABELS) + LABEL_SQL)


# ---- MOD-006 / MOD-007 -------------------------------------------------------------------------------

def whales_e(spark, sf):
    return whale_detect(A.trades_e(spark, sf), CFG)


def flows(spark, sf):
    return FL.flow_aggregate(whales_e(spark, sf), FLOW_W)


FLOW_SQL = f""",
wh AS (SELECT *, CASE WHEN quote_volume > 1000000 THEN 'critical' WHEN quote_volume > 500000 THEN 'high'
                 ELSE 'medium' END AS severity FROM trades_e WHERE quote_volume > 100000),
fl0 AS (
  SELECT time_bucket(INTERVAL 6 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS window_start, symbol,
    coalesce(sum(CAST(quote_volume AS DECIMAL(28,8))) FILTER (WHERE side = 'buy'), 0) AS b,
    coalesce(sum(CAST(quote_volume AS DECIMAL(28,8))) FILTER (WHERE side = 'sell'), 0) AS s,
    count(*) AS whale_count
  FROM wh GROUP BY 1, 2),
fl AS (
  SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, symbol, CAST(b AS DOUBLE) AS buy_volume,
    CAST(s AS DOUBLE) AS sell_volume, CAST(b - s AS DOUBLE) AS net_flow,
    CAST(b AS DOUBLE) / CAST(b + s AS DOUBLE) AS flow_ratio, whale_count FROM fl0),
fla AS (
  SELECT *, CASE WHEN flow_ratio > 0.7 THEN 'accumulation_signal' ELSE 'distribution_signal' END AS alert_type,
    CASE WHEN flow_ratio > 0.85 OR flow_ratio < 0.15 THEN 'high' ELSE 'medium' END AS severity
  FROM fl WHERE flow_ratio > 0.7 OR flow_ratio < 0.3)"""


@query("flow_aggregate")
def q_flow_aggregate(spark, sf):
    f = flows(spark, sf)
    return f.select("window_start", "window_end", "symbol", "buy_volume", "sell_volume", "net_flow",
                    stable_round("flow_ratio", 6).alias("flow_ratio"), "whale_count")


sql("flow_aggregate", with_(TRADES_E) + FLOW_SQL + f"""
SELECT window_start, window_end, symbol, buy_volume, sell_volume, net_flow, {sround('flow_ratio', 6)} AS flow_ratio,
  whale_count FROM fl""")

FLOW_FIELDS = {"flow_ratio": "double", "whale_count": "long"}


@query("flow_alerts")
def q_flow_alerts(spark, sf):
    a = alert_view(FL.flow_alerts(flows(spark, sf)), FLOW_FIELDS)
    return a.withColumn("d_flow_ratio", stable_round("d_flow_ratio", 6))


sql("flow_alerts", with_(TRADES_E) + FLOW_SQL + f"""
SELECT {alert_id('alert_type', 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')} AS alert_id, alert_type,
  'MOD-006' AS module_id, symbol, CAST(NULL AS VARCHAR) AS exchange, severity, window_end AS detected_at,
  printf('%s on %s: %d buy vs %d sell USD', alert_type, symbol, CAST(floor(buy_volume) AS BIGINT),
         CAST(floor(sell_volume) AS BIGINT)) AS message, {ttl('window_end')} AS ttl_epoch,
  {sround('flow_ratio', 6)} AS d_flow_ratio, whale_count AS d_whale_count FROM fla""")


def consensus_inputs(spark, sf):
    vs = vol_scored(spark, sf).withColumn(
        "alert_id", alert_id_col(F.lit("volume_spike"), "exchange", "symbol", F.unix_seconds("window_start")))
    wh = whales_e(spark, sf).withColumn("alert_id", alert_id_col(F.lit("whale_trade"), "exchange", "symbol", "event_id"))
    fl = flows(spark, sf)
    r = F.col("flow_ratio")
    ftype = F.when(r > 0.7, "accumulation_signal").when(r < 0.3, "distribution_signal")
    fl = fl.withColumn("alert_id", F.when(ftype.isNotNull(), alert_id_col(
        ftype, F.lit(None).cast("string"), "symbol", F.unix_seconds("window_start"))))
    return vs, wh, fl


def consensus(spark, sf):
    return FL.consensus_score(FL.consensus_signals(*consensus_inputs(spark, sf), FLOW_W))


CONS_SQL = VOL_ALERTS_SQL + FLOW_SQL + f""",
u AS (
  SELECT time_bucket(INTERVAL 6 HOUR, window_start, TIMESTAMP '1970-01-01') AS window_start, symbol,
    least(abs(z_score) / 3.5, 1.0) AS v, NULL::DOUBLE AS w, NULL::DOUBLE AS f, NULL::DOUBLE AS flow_ratio,
    alert_id AS aid, NULL::DOUBLE AS buy, NULL::DOUBLE AS sell
  FROM vol_alerts
  UNION ALL
  SELECT time_bucket(INTERVAL 6 HOUR, "timestamp", TIMESTAMP '1970-01-01'), symbol, NULL,
    CASE severity WHEN 'medium' THEN 0.5 WHEN 'high' THEN 0.75 WHEN 'critical' THEN 1.0 END, NULL, NULL,
    {alert_id("'whale_trade'", 'exchange', 'symbol', 'event_id')}, NULL, NULL
  FROM wh
  UNION ALL
  SELECT window_start, symbol, NULL, NULL, abs(2.0 * flow_ratio - 1.0), flow_ratio,
    CASE WHEN flow_ratio > 0.7 OR flow_ratio < 0.3 THEN
      {alert_id("CASE WHEN flow_ratio > 0.7 THEN 'accumulation_signal' ELSE 'distribution_signal' END", 'NULL',
                'symbol', 'epoch_us(window_start) // 1000000')} END, buy_volume, sell_volume
  FROM fl),
cs AS (
  SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, symbol,
    coalesce(max(v), 0.0) AS volume_signal, coalesce(max(w), 0.0) AS whale_signal, coalesce(max(f), 0.0) AS flow_signal,
    max(flow_ratio) AS flow_ratio, count(aid) AS contributing
  FROM u GROUP BY window_start, symbol),
cscore AS (
  SELECT *, 100.0 * (0.3 * volume_signal + 0.3 * whale_signal + 0.4 * flow_signal) AS consensus_score FROM cs)"""


@query("consensus_signals")
def q_consensus_signals(spark, sf):
    c = consensus(spark, sf)
    return c.select("window_start", "window_end", "symbol", stable_round("volume_signal", 6).alias("volume_signal"),
                    "whale_signal", stable_round("flow_signal", 6).alias("flow_signal"),
                    "contributing")


sql("consensus_signals", with_(TRADES_E) + VOL_SQL + CONS_SQL + f"""
SELECT window_start, window_end, symbol, {sround('volume_signal', 6)} AS volume_signal, whale_signal,
  {sround('flow_signal', 6)} AS flow_signal, contributing FROM cscore""")


@query("consensus_contributions")
def q_consensus_contributions(spark, sf):
    """Every alert behind a consensus row, as rows."""
    return FL.consensus_contributions(*consensus_inputs(spark, sf), FLOW_W)


sql("consensus_contributions", with_(TRADES_E) + VOL_SQL + CONS_SQL + """
SELECT window_start, symbol, aid AS alert_id FROM u WHERE aid IS NOT NULL""")


@query("consensus_score")
def q_consensus_score(spark, sf):
    c = consensus(spark, sf)
    return c.select("window_start", "symbol", stable_round("consensus_score", 6).alias("consensus_score"))


sql("consensus_score", with_(TRADES_E) + VOL_SQL + CONS_SQL + f"""
SELECT window_start, symbol, {sround('consensus_score', 6)} AS consensus_score FROM cscore""")

CONS_FIELDS = {"consensus_score": "double"}


@query("consensus_alerts")
def q_consensus_alerts(spark, sf):
    alerts = FL.consensus_alerts(consensus(spark, sf))
    contributing = F.get_json_object("details", "$.contributing_alerts").cast("long")
    a = alert_view(alerts.withColumn("d_contributing", contributing), CONS_FIELDS)
    return a.withColumn("d_consensus_score", stable_round("d_consensus_score", 6))


sql("consensus_alerts", with_(TRADES_E) + VOL_SQL + CONS_SQL + f""",
ca AS (SELECT *, CASE WHEN flow_ratio > 0.5 THEN 'consensus_bullish' ELSE 'consensus_bearish' END AS alert_type
       FROM cscore WHERE consensus_score > 70 AND flow_ratio IS NOT NULL AND flow_ratio <> 0.5)
SELECT {alert_id('alert_type', 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')} AS alert_id, alert_type,
  'MOD-007' AS module_id, symbol, CAST(NULL AS VARCHAR) AS exchange,
  CASE WHEN consensus_score > 85 THEN 'high' ELSE 'medium' END AS severity, window_end AS detected_at,
  alert_type || ' on ' || symbol AS message, {ttl('window_end')} AS ttl_epoch,
  {sround('consensus_score', 6)} AS d_consensus_score, contributing AS d_contributing FROM ca""")
