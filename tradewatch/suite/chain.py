"""Registered queries: MOD-008 on-chain and MOD-009 DEX.
Events come from ``orders`` and swap legs from ``lineitem`` (FIXTURES 4.3);
the data is day-grain, so DEX windows are days and weeks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.functions.columns import stable_round
from tradewatch.operators import onchain as O
from tradewatch.sources import adapters as A
from tradewatch.suite.core import alert_view
from tradewatch.suite.oracle import DEX_SWAPS, ONCHAIN_RAW, WALLET_LABELS, alert_id, sround, ttl, with_
from tradewatch.suite.registry import query, sql

CFG = make_config()
DEX_W = "1 day"
LIQ_W = "7 days"
LIQ_PCT = 10.0


def events(spark, sf):
    return O.onchain_normalise(A.onchain_eth_raw(spark, sf), A.onchain_sol_raw(spark, sf))


def swaps(spark, sf):
    return O.dex_decode(A.dex_swaps_raw(spark, sf))


@query("onchain_normalise")
def q_onchain_normalise(spark, sf):
    return events(spark, sf).select(*O.EVENT_COLS)


sql("onchain_normalise", with_(ONCHAIN_RAW) + """
SELECT tx, blockchain, from_wallet, to_wallet, kind, protocol, value_usd, block_timestamp FROM onchain_raw""")

SWAP_FIELDS = {"tx": "string", "protocol": "string", "value_usd": "double"}


@query("onchain_swap_filter")
def q_onchain_swap_filter(spark, sf):
    r = O.routers_frame(spark, CFG["onchain"]["routers"])
    return alert_view(O.onchain_swap_filter(events(spark, sf), r), SWAP_FIELDS)


sql("onchain_swap_filter", with_(ONCHAIN_RAW) + f"""
SELECT {alert_id("'dex_swap'", 'NULL', 'NULL', 'blockchain', 'tx')} AS alert_id, 'dex_swap' AS alert_type,
  'MOD-008' AS module_id, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS exchange,
  CASE WHEN value_usd > 100000 THEN 'medium' ELSE 'low' END AS severity, block_timestamp AS detected_at,
  printf('Swap of %d USD via %s on %s', CAST(floor(value_usd) AS BIGINT), protocol, blockchain) AS message,
  {ttl('block_timestamp')} AS ttl_epoch, tx AS d_tx, protocol AS d_protocol, value_usd AS d_value_usd
FROM onchain_raw WHERE kind = 'swap' AND protocol IN ('uniswap', 'jupiter', 'sushiswap', 'raydium')""")

TRANSFER_FIELDS = {"tx": "string", "from_wallet": "string", "value_usd": "double"}


@query("onchain_large_transfer")
def q_onchain_large_transfer(spark, sf):
    return alert_view(O.onchain_large_transfer(events(spark, sf)), TRANSFER_FIELDS)


sql("onchain_large_transfer", with_(ONCHAIN_RAW) + f"""
SELECT {alert_id("'large_transfer'", 'NULL', 'NULL', 'blockchain', 'tx')} AS alert_id, 'large_transfer' AS alert_type,
  'MOD-008' AS module_id, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS exchange,
  CASE WHEN value_usd > 1000000 THEN 'high' ELSE 'medium' END AS severity, block_timestamp AS detected_at,
  printf('Transfer of %d USD on %s', CAST(floor(value_usd) AS BIGINT), blockchain) AS message,
  {ttl('block_timestamp')} AS ttl_epoch, tx AS d_tx, CAST(from_wallet AS VARCHAR) AS d_from_wallet,
  value_usd AS d_value_usd
FROM onchain_raw WHERE kind = 'transfer' AND value_usd > 50000""")


@query("onchain_known_wallet")
def q_onchain_known_wallet(spark, sf):
    return O.onchain_known_wallet(events(spark, sf), A.wallet_labels(spark, sf)).select(*O.EVENT_COLS)


sql("onchain_known_wallet", with_(ONCHAIN_RAW, WALLET_LABELS) + """
SELECT tx, blockchain, from_wallet, to_wallet, kind, protocol, value_usd, block_timestamp FROM onchain_raw
WHERE from_wallet IN (SELECT wallet FROM wallet_labels) OR to_wallet IN (SELECT wallet FROM wallet_labels)""")

DEX_COLS = ["tx", "log_index", "leg_id", "blockchain", "protocol", "swap_timestamp", "pair", "amount_in", "amount_out",
            "amount_usd"]


@query("dex_decode")
def q_dex_decode(spark, sf):
    return swaps(spark, sf).select(*DEX_COLS, "effective_price")


sql("dex_decode", with_(DEX_SWAPS) + f"SELECT {', '.join(DEX_COLS)}, effective_price FROM dex")


@query("dex_volume")
def q_dex_volume(spark, sf):
    return O.dex_volume(swaps(spark, sf), DEX_W)


sql("dex_volume", with_(DEX_SWAPS) + """
SELECT time_bucket(INTERVAL 1 DAY, swap_timestamp, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 1 DAY, swap_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end, pair, protocol,
  CAST(sum(CAST(amount_usd AS DECIMAL(28,8))) AS DOUBLE) AS volume_usd, count(*) AS swap_count
FROM dex GROUP BY 1, 2, 3, 4""")

IMPACT_SQL = """,
imp AS (
  SELECT *, lag(effective_price) OVER (PARTITION BY pair, protocol ORDER BY swap_timestamp, tx, leg_id, amount_usd, amount_in) AS prev_price
  FROM dex),
imp2 AS (SELECT *, (effective_price - prev_price) / prev_price AS price_impact FROM imp)"""


@query("dex_price_impact")
def q_dex_price_impact(spark, sf):
    d = O.dex_price_impact(swaps(spark, sf))
    return d.select("tx", "leg_id", "pair", "protocol", "effective_price",
                    F.col("prev_effective_price").alias("prev_price"), "price_impact")


sql("dex_price_impact", with_(DEX_SWAPS) + IMPACT_SQL + """
SELECT tx, leg_id, pair, protocol, effective_price, prev_price, price_impact FROM imp2""")

LARGE_FIELDS = {"tx": "string", "leg_id": "string", "amount_usd": "double", "price_impact": "double"}


@query("dex_large_swaps")
def q_dex_large_swaps(spark, sf):
    return alert_view(O.dex_large_swaps(O.dex_price_impact(swaps(spark, sf))), LARGE_FIELDS)


sql("dex_large_swaps", with_(DEX_SWAPS) + IMPACT_SQL + f"""
SELECT {alert_id("'large_dex_swap'", 'NULL', 'pair', 'protocol', 'tx', 'leg_id')} AS alert_id,
  'large_dex_swap' AS alert_type, 'MOD-009' AS module_id, pair AS symbol, CAST(NULL AS VARCHAR) AS exchange,
  CASE WHEN amount_usd > 1000000 THEN 'high' ELSE 'medium' END AS severity, swap_timestamp AS detected_at,
  printf('Swap of %d USD on %s via %s', CAST(floor(amount_usd) AS BIGINT), pair, protocol) AS message,
  {ttl('swap_timestamp')} AS ttl_epoch, tx AS d_tx, leg_id AS d_leg_id, amount_usd AS d_amount_usd,
  price_impact AS d_price_impact
FROM imp2 WHERE amount_usd > 100000""")

LIQ_SQL = f""",
lq0 AS (
  SELECT time_bucket(INTERVAL 7 DAY, swap_timestamp, TIMESTAMP '1970-01-01') AS window_start, pair, protocol,
    sum(CAST(amount_in AS DECIMAL(28,8)) - CAST(amount_out AS DECIMAL(28,8))) AS net
  FROM dex GROUP BY 1, 2, 3),
lq1 AS (
  SELECT *, sum(net) OVER (PARTITION BY pair, protocol ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS liq
  FROM lq0),
lq AS (
  SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, pair, protocol, CAST(net AS DOUBLE) AS net_change,
    CAST(liq AS DOUBLE) AS liquidity, CAST(lag(liq) OVER (PARTITION BY pair, protocol ORDER BY window_start) AS DOUBLE)
      AS prev_liquidity
  FROM lq1),
lqc AS (SELECT *, net_change / abs(prev_liquidity) * 100.0 AS change_pct FROM lq)"""


@query("dex_liquidity_change")
def q_dex_liquidity_change(spark, sf):
    a = alert_view(O.dex_liquidity_change(swaps(spark, sf), LIQ_W, LIQ_PCT), {"change_pct": "double",
                                                                              "liquidity": "double"})
    return a.withColumn("d_change_pct", stable_round("d_change_pct", 6))


sql("dex_liquidity_change", with_(DEX_SWAPS) + LIQ_SQL + f"""
SELECT {alert_id("'liquidity_change'", 'NULL', 'pair', 'protocol', 'epoch_us(window_start) // 1000000')} AS alert_id,
  'liquidity_change' AS alert_type, 'MOD-009' AS module_id, pair AS symbol, CAST(NULL AS VARCHAR) AS exchange,
  CASE WHEN abs(change_pct) > 100.0 THEN 'high' ELSE 'medium' END AS severity, window_end AS detected_at,
  'Liquidity of ' || pair || ' on ' || protocol || ' changed by more than {LIQ_PCT} %' AS message,
  {ttl('window_end')} AS ttl_epoch, {sround('change_pct', 6)} AS d_change_pct, liquidity AS d_liquidity
FROM lqc WHERE abs(change_pct) > {LIQ_PCT}""")
