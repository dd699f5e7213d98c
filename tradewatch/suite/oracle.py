"""DuckDB oracle SQL: independent statements of each registered query over the
driver's pre-registered views. Shared CTEs re-state the adapters."""

from __future__ import annotations

import json

from tradewatch.config import make_config
from tradewatch.operators.lineage import lin_config_hash

SQL: dict[str, str] = {}

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

TRADES_E = f"""
trades_e0 AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS n,
    CASE WHEN event_id % 2 = 0 THEN 'binance' ELSE 'coinbase' END AS exchange,
    CASE user_id % 3 WHEN 0 THEN 'BTC-USDT' WHEN 1 THEN 'ETH-USDT' ELSE 'SOL-USDT' END AS symbol,
    (CASE user_id % 3 WHEN 0 THEN CAST(67432.5 AS DOUBLE) WHEN 1 THEN CAST(3200.0 AS DOUBLE)
      ELSE CAST(150.0 AS DOUBLE) END) * (9950 + {K}) / CAST(10000.0 AS DOUBLE) AS price,
    value AS quantity,
    CASE WHEN event_id % 3 = 0 THEN 'sell' ELSE 'buy' END AS side,
    CAST(ts AS TIMESTAMP) AS "timestamp",
    make_timestamp(epoch_us(ts) + CAST({K} AS BIGINT) * 5000000) AS ingestion_timestamp
  FROM events),
trades_e AS (
  SELECT event_id, n, exchange, symbol, price, quantity, price * quantity AS quote_volume, side,
         "timestamp", ingestion_timestamp FROM trades_e0)"""

TRADES_L = """
trades_l AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
    CASE WHEN l_linestatus = 'F' THEN 'binance' ELSE 'coinbase' END AS exchange,
    CASE WHEN l_returnflag = 'A' THEN 'BTC-USDT' WHEN l_returnflag = 'N' THEN 'ETH-USDT' ELSE 'SOL-USDT' END AS symbol,
    l_extendedprice / l_quantity AS price, l_quantity AS quantity, l_extendedprice AS quote_volume,
    CASE WHEN l_discount > l_tax THEN 'buy' ELSE 'sell' END AS side,
    CAST(l_shipdate AS TIMESTAMP) AS "timestamp", CAST(l_shipdate AS TIMESTAMP) AS ingestion_timestamp,
    l_discount - l_tax AS ret, l_orderkey
  FROM lineitem)"""

WALLET_TRADES = TRADES_L + """,
wallet_trades AS (
  SELECT o_custkey AS wallet, CASE WHEN o_custkey % 2 = 0 THEN 'ethereum' ELSE 'solana' END AS blockchain,
    event_id, exchange, symbol, price, quantity, quote_volume, side, "timestamp" AS ts, ret
  FROM trades_l JOIN orders ON l_orderkey = o_orderkey)"""

WALLET_LIVE = WALLET_TRADES + """,
wallet_live AS (
  SELECT wallet, blockchain, event_id, exchange, symbol, price, quantity, quote_volume, side, ret,
    TIMESTAMP '2024-01-01' + to_minutes(17 * date_diff('day', DATE '1992-01-01', CAST(ts AS DATE))) AS ts FROM wallet_trades)"""

WALLET_LABELS = """
wallet_labels AS (
  SELECT c_custkey AS wallet, c_name AS label, c_mktsegment AS entity_type FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""

ONCHAIN_RAW = """
onchain_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS tx,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'ethereum' WHEN o_orderpriority = '2-HIGH' THEN 'solana'
         WHEN o_custkey % 2 = 0 THEN 'ethereum' ELSE 'solana' END AS blockchain,
    o_custkey AS from_wallet, (o_custkey * 7) % (SELECT max(c_custkey) FROM customer) AS to_wallet,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'swap' ELSE 'transfer' END AS kind,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'uniswap' WHEN o_orderpriority = '2-HIGH' THEN 'jupiter' END AS protocol,
    o_totalprice AS value_usd, CAST(o_orderdate AS TIMESTAMP) AS block_timestamp
  FROM orders)"""

DEX_SWAPS = ONCHAIN_RAW + """,
dex_swaps AS (
  SELECT s.tx, l_linenumber AS log_index, concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS leg_id, s.blockchain, s.protocol, s.block_timestamp AS swap_timestamp,
    CASE WHEN l_returnflag = 'A' THEN 'WBTC-USDC' WHEN l_returnflag = 'N' THEN 'WETH-USDC' ELSE 'SOL-USDC' END AS pair,
    l_quantity AS amount_in, l_quantity * (1.0 - l_discount) AS amount_out, l_extendedprice AS amount_usd
  FROM onchain_raw s JOIN lineitem ON s.tx = CAST(l_orderkey AS VARCHAR)
  WHERE s.kind = 'swap'),
dex AS (
  SELECT *, amount_usd / amount_out AS effective_price FROM dex_swaps)"""


def iso_ms(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def alert_id(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"substr(sha256(concat_ws('|', {inner})), 1, 32)"


def ttl(x: str, hours: int = 24) -> str:
    return f"(epoch_us({x}) // 1000000 + {hours * 3600})"


def corr_id(ts: str = '"timestamp"') -> str:
    return f"substr(sha256(concat_ws(':', exchange, symbol, {iso_ms(ts)})), 1, 16)"


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,8))) AS DOUBLE)"


def config_hash(section: str) -> str:
    return lin_config_hash(make_config()[section])


def json_lit(obj) -> str:
    return json.dumps(obj, sort_keys=True, separators=(",", ":")).replace("'", "''")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def sround(x: str, places: int = 4) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"
