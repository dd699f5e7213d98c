"""Registered queries: normalisation, lineage, quality, whale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.functions import columns as C
from tradewatch.operators import lineage as L
from tradewatch.operators import normalize as N
from tradewatch.operators import quality as Q
from tradewatch.operators.alerts import ALERT_COLUMNS
from tradewatch.operators.whale import whale_alerts, whale_detect, whale_filter, whale_severity
from tradewatch.sources import adapters as A
from tradewatch.suite.oracle import (
    TRADES_E, alert_id, config_hash, corr_id, iso_ms, json_lit, ttl, with_,
)
from tradewatch.suite.registry import PROCESSED_AT, query, sql

CFG = make_config()
INGESTED_AT = "2024-02-01 00:00:00"
TRADE_COLS = ["event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side", "timestamp"]


def alert_view(alerts: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Base alert columns with ``details`` fields parsed back into typed
    columns (JSON number text differs between engines; values do not)."""
    base = [c for c in ALERT_COLUMNS if c != "details"] + [c for c in alerts.columns if c.startswith("d_")]
    return alerts.select(*base, *[F.get_json_object("details", f"$.{k}").cast(t).alias(f"d_{k.split('.')[-1]}")
                                  for k, t in fields.items()])


def whales_with_lineage(spark, sf) -> DataFrame:
    w = L.with_correlation_id(whale_detect(A.trades_e(spark, sf), CFG))
    return L.lin_attach(w, "MOD-002", "whale-detector", CFG["whale_detector"], PROCESSED_AT)


# ---- MOD-002 -------------------------------------------------------------------------------

@query("whale_filter")
def q_whale_filter(spark, sf):
    return whale_filter(A.trades_e(spark, sf), CFG["whale_detector"]["min_quote_volume_usd"]).select(*TRADE_COLS)


sql("whale_filter", with_(TRADES_E) + """
SELECT event_id, exchange, symbol, price, quantity, quote_volume, side, "timestamp"
FROM trades_e WHERE quote_volume > 100000""")

SEVERITY_SQL = ("CASE WHEN quote_volume > 1000000 THEN 'critical' WHEN quote_volume > 500000 THEN 'high' "
                "ELSE 'medium' END")


@query("whale_severity")
def q_whale_severity(spark, sf):
    return whale_severity(whale_filter(A.trades_e(spark, sf))).select(*TRADE_COLS, "severity")


sql("whale_severity", with_(TRADES_E) + f"""
SELECT event_id, exchange, symbol, price, quantity, quote_volume, side, "timestamp", {SEVERITY_SQL} AS severity
FROM trades_e WHERE quote_volume > 100000""")

WHALE_FIELDS = {"quote_volume": "double", "price": "double", "quantity": "double", "side": "string",
                "_lineage.correlation_id": "string"}


@query("whale_alerts")
def q_whale_alerts(spark, sf):
    return alert_view(whale_alerts(whales_with_lineage(spark, sf)), WHALE_FIELDS)


WHALE_ALERTS_SQL = f"""
whale_alerts AS (
  SELECT {alert_id("'whale_trade'", 'exchange', 'symbol', 'event_id')} AS alert_id, 'whale_trade' AS alert_type,
    'MOD-002' AS module_id, symbol, exchange, {SEVERITY_SQL} AS severity, "timestamp" AS detected_at,
    printf('Whale %s of %d USD on %s %s', side, CAST(floor(quote_volume) AS BIGINT), exchange, symbol) AS message,
    {ttl('"timestamp"')} AS ttl_epoch, quote_volume AS d_quote_volume, price AS d_price, quantity AS d_quantity,
    side AS d_side, {corr_id()} AS d_correlation_id, event_id
  FROM trades_e WHERE quote_volume > 100000)"""
ALERT_BASE = "alert_id, alert_type, module_id, symbol, exchange, severity, detected_at, message, ttl_epoch"

sql("whale_alerts", with_(TRADES_E, WHALE_ALERTS_SQL) + f"""
SELECT {ALERT_BASE}, d_quote_volume, d_price, d_quantity, d_side, d_correlation_id FROM whale_alerts""")


# ---- 2.2 normalisation ------------------------------------------------------------------------

def venue_a_norm(spark, sf):
    return N.norm_venue_a(N.norm_unwrap(A.raw_a(spark, sf)), ingested_at=INGESTED_AT)


def venue_b_norm(spark, sf):
    return N.norm_venue_b(A.raw_b(spark, sf), ingested_at=INGESTED_AT)


@query("norm_unwrap")
def q_norm_unwrap(spark, sf):
    u = N.norm_unwrap(A.raw_a(spark, sf))
    g = lambda k: F.get_json_object("value", f"$.{k}")
    return u.select(g("t").alias("event_id"), g("s").alias("raw_symbol"), g("p").cast("double").alias("price"),
                    g("q").cast("double").alias("quantity"), g("T").cast("long").alias("trade_ms"),
                    g("m").cast("boolean").alias("maker"))


sql("norm_unwrap", with_(TRADES_E) + """
SELECT event_id, replace(symbol, '-', '') AS raw_symbol, price, quantity, epoch_us("timestamp") // 1000 AS trade_ms,
  side = 'sell' AS maker
FROM trades_e WHERE n % 2 = 0""")

NORM_OUT = ["event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side", "timestamp",
            "ingestion_timestamp"]
TRUNC_SQL = f"""SELECT event_id, exchange, symbol, price, quantity, quote_volume, side,
  date_trunc('millisecond', "timestamp") AS "timestamp", TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp
FROM trades_e"""


@query("norm_venue_a")
def q_norm_venue_a(spark, sf):
    return venue_a_norm(spark, sf).select(*NORM_OUT)


sql("norm_venue_a", with_(TRADES_E) + TRUNC_SQL + " WHERE n % 2 = 0")


@query("norm_match_filter")
def q_norm_match_filter(spark, sf):
    m = N.norm_match_filter(A.raw_b(spark, sf))
    return m.select("key", F.get_json_object("value", "$.type").alias("type"))


sql("norm_match_filter", with_(TRADES_E) + """
SELECT event_id AS key, CASE WHEN n % 5 = 0 THEN 'last_match' ELSE 'match' END AS type
FROM trades_e WHERE n % 2 = 1""")


@query("norm_venue_b")
def q_norm_venue_b(spark, sf):
    return venue_b_norm(spark, sf).select(*NORM_OUT)


sql("norm_venue_b", with_(TRADES_E) + TRUNC_SQL + " WHERE n % 2 = 1")


@query("norm_union")
def q_norm_union(spark, sf):
    return N.norm_union(venue_a_norm(spark, sf), venue_b_norm(spark, sf)).select(*NORM_OUT)


sql("norm_union", with_(TRADES_E) + TRUNC_SQL)

# Test input lists for the symbol helpers (not reference values).
RAW_PAIRS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "ETHBTC", "SOLETH", "XRPBNB", "dogeusdt"]
PRODUCTS = ["BTC-USD", "ETH-USD", "SOL-USD", "ETH-BTC", "SOL-ETH"]
CONFIG_SYMBOLS = ["btcusdt", "ethusdt", "solusdt", "ethbtc", "soleth", "xrpbnb"]


def _pick(values, n_col: str) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(F.col(n_col) % len(values) == i, F.lit(v)) if expr is None
                else expr.when(F.col(n_col) % len(values) == i, F.lit(v)))
    return expr


def _pick_sql(values, n_col: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {n_col} % {len(values)} {arms} END"


def _split_sql(s: str, rules) -> str:
    u = f"upper({s})"
    arms = " ".join(f"WHEN {u} LIKE '%{q}' THEN substr({u}, 1, length({u}) - {len(q)}) || '{sep}{out}'"
                    for q, sep, out in rules)
    return f"CASE {arms} ELSE {u} END"


@query("norm_symbol")
def q_norm_symbol(spark, sf):
    ev = A.table(spark, sf, "events").select("event_id", _pick(RAW_PAIRS, "user_id").alias("raw_symbol"))
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "raw_symbol",
                     C.norm_symbol("raw_symbol").alias("symbol"))


sql("norm_symbol", f"""
WITH e AS (SELECT event_id, {_pick_sql(RAW_PAIRS, 'user_id')} AS raw_symbol FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, raw_symbol,
  {_split_sql('raw_symbol', [('USDT', '-', 'USDT'), ('BTC', '-', 'BTC'), ('ETH', '-', 'ETH')])} AS symbol
FROM e""")


@query("norm_symbol_usd")
def q_norm_symbol_usd(spark, sf):
    ev = A.table(spark, sf, "events").select("event_id", _pick(PRODUCTS, "user_id").alias("product_id"))
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "product_id",
                     C.norm_symbol_usd("product_id").alias("symbol"))


sql("norm_symbol_usd", f"""
WITH e AS (SELECT event_id, {_pick_sql(PRODUCTS, 'user_id')} AS product_id FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, product_id,
  CASE WHEN product_id LIKE '%-USD' THEN product_id || 'T' ELSE product_id END AS symbol
FROM e""")


@query("norm_product_id")
def q_norm_product_id(spark, sf):
    ev = A.table(spark, sf, "events").select("event_id", _pick(CONFIG_SYMBOLS, "user_id").alias("config_symbol"))
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "config_symbol",
                     C.norm_product_id("config_symbol").alias("product_id"))


sql("norm_product_id", f"""
WITH e AS (SELECT event_id, {_pick_sql(CONFIG_SYMBOLS, 'user_id')} AS config_symbol FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, config_symbol,
  {_split_sql('config_symbol', [('USDT', '-', 'USD'), ('BTC', '-', 'BTC'), ('ETH', '-', 'ETH')])} AS product_id
FROM e""")


@query("norm_epoch_ms")
def q_norm_epoch_ms(spark, sf):
    ev = A.table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("epoch_ms"))
    ts = C.norm_epoch_ms("epoch_ms")
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "epoch_ms", ts.alias("timestamp"),
                     C.iso_ms(ts).alias("timestamp_iso"))


sql("norm_epoch_ms", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, epoch_us(ts) // 1000 AS epoch_ms,
  make_timestamp((epoch_us(ts) // 1000) * 1000) AS "timestamp",
  {iso_ms('ts')} AS timestamp_iso
FROM events""")


@query("norm_iso_ms")
def q_norm_iso_ms(spark, sf):
    ev = A.table(spark, sf, "events").select(
        "event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time_us"))
    ts = C.norm_iso_ms("time_us")
    return ev.select(F.col("event_id").cast("string").alias("event_id"), "time_us", ts.alias("timestamp"),
                     C.iso_ms(ts).alias("timestamp_iso"))


sql("norm_iso_ms", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time_us,
  date_trunc('millisecond', ts) AS "timestamp", {iso_ms('ts')} AS timestamp_iso
FROM events""")


@query("norm_quote_volume")
def q_norm_quote_volume(spark, sf):
    t = A.trades_e(spark, sf)
    return t.select("event_id", "price", "quantity", C.norm_quote_volume("price", "quantity").alias("quote_volume"))


sql("norm_quote_volume", with_(TRADES_E) + "SELECT event_id, price, quantity, quote_volume FROM trades_e")


@query("norm_ingest_stamp")
def q_norm_ingest_stamp(spark, sf):
    t = A.trades_e(spark, sf)
    return t.select("event_id", C.norm_ingest_stamp(INGESTED_AT).alias("ingestion_timestamp"))


sql("norm_ingest_stamp", with_(TRADES_E) +
    f"SELECT event_id, TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp FROM trades_e")


@query("norm_symbol_subset")
def q_norm_symbol_subset(spark, sf):
    return N.norm_symbol_subset(A.trades_e(spark, sf), ["BTC-USDT", "ETH-USDT"]).select(*TRADE_COLS)


sql("norm_symbol_subset", with_(TRADES_E) + """
SELECT event_id, exchange, symbol, price, quantity, quote_volume, side, "timestamp" FROM trades_e
WHERE symbol IN ('BTC-USDT', 'ETH-USDT')""")


@query("norm_payload")
def q_norm_payload(spark, sf):
    t = A.trades_e(spark, sf)
    t = t.withColumn("symbol", F.when(F.col("event_id").cast("long") % 43 != 0, F.col("symbol")))
    p = N.norm_payload(t)
    g = lambda k: F.get_json_object("payload", f"$.{k}")
    return p.select("partition_key", g("event_id").alias("event_id"), g("price").cast("double").alias("price"),
                    g("quote_volume").cast("double").alias("quote_volume"), g("timestamp").alias("timestamp_iso"),
                    g("symbol").alias("symbol"))


sql("norm_payload", with_(TRADES_E) + f"""
SELECT coalesce(CASE WHEN n % 43 <> 0 THEN symbol END, 'unknown') AS partition_key, event_id, price, quote_volume,
  {iso_ms('"timestamp"')} AS timestamp_iso, CASE WHEN n % 43 <> 0 THEN symbol END AS symbol
FROM trades_e""")


# ---- 2.3 lineage ------------------------------------------------------------------------------

@query("lin_correlation_id")
def q_lin_correlation_id(spark, sf):
    return L.with_correlation_id(A.trades_e(spark, sf)).select("event_id", "exchange", "symbol", "correlation_id")


sql("lin_correlation_id", with_(TRADES_E) + f"SELECT event_id, exchange, symbol, {corr_id()} AS correlation_id FROM trades_e")


@query("lin_config_hash")
def q_lin_config_hash(spark, sf):
    w = whale_detect(A.trades_e(spark, sf), CFG)
    return w.select("event_id", F.lit(L.lin_config_hash(CFG["whale_detector"])).alias("config_hash"))


sql("lin_config_hash", with_(TRADES_E) + f"""
SELECT event_id, sha256('{json_lit(CFG['whale_detector'])}') AS config_hash FROM trades_e WHERE quote_volume > 100000""")


@query("lin_attach")
def q_lin_attach(spark, sf):
    return whales_with_lineage(spark, sf).select("event_id", F.to_json("_lineage").alias("lineage_json"))


sql("lin_attach", with_(TRADES_E) + f"""
SELECT event_id, to_json({{'correlation_id': {corr_id()}, 'source_table': 'raw_trades', 'source_event_id': event_id,
  'module_id': 'MOD-002', 'detector_name': 'whale-detector', 'config_hash': '{config_hash('whale_detector')}',
  'processed_at': '{PROCESSED_AT}', 'pipeline_version': 'dev'}})::VARCHAR AS lineage_json
FROM trades_e WHERE quote_volume > 100000""")


@query("lin_merge_details")
def q_lin_merge_details(spark, sf):
    w = whales_with_lineage(spark, sf).withColumn("details", F.struct("quote_volume", "side"))
    m = L.lin_merge_details(w)
    g = lambda k: F.get_json_object("details", f"$.{k}")
    return m.select("event_id", g("quote_volume").cast("double").alias("d_quote_volume"), g("side").alias("d_side"),
                    g("_lineage.source_event_id").alias("l_source_event_id"),
                    g("_lineage.correlation_id").alias("l_correlation_id"),
                    g("_lineage.config_hash").alias("l_config_hash"))


sql("lin_merge_details", with_(TRADES_E) + f"""
SELECT event_id, quote_volume AS d_quote_volume, side AS d_side, event_id AS l_source_event_id,
  {corr_id()} AS l_correlation_id, '{config_hash('whale_detector')}' AS l_config_hash
FROM trades_e WHERE quote_volume > 100000""")


# ---- 2.4 quality ------------------------------------------------------------------------------

DQ_CFG = make_config({"quality": {"custom_rules": [
    {"name": "max_notional", "expr": "quote_volume < 5000000", "severity": "error"},
    {"name": "odd_lot", "expr": "quantity >= 1", "severity": "warn"},
]}})
AS_OF_DAY = "2024-02-01"

DIRTY = f"""
dirty0 AS (
  SELECT t.*, s.shift FROM trades_e t JOIN (SELECT 0 AS shift UNION ALL SELECT 10) s
    ON s.shift = 0 OR t.n % 59 = 0),
dirty AS (
  SELECT event_id AS key, n % 61 = 0 AS malformed,
    CASE WHEN n % 61 <> 0 THEN event_id END AS event_id,
    CASE WHEN n % 61 <> 0 THEN (CASE WHEN n % 47 = 0 THEN 'kraken' ELSE exchange END) END AS exchange,
    CASE WHEN n % 61 <> 0 THEN (CASE WHEN n % 43 = 0 THEN 'DOGE-XYZ' ELSE symbol END) END AS symbol,
    CASE WHEN n % 61 <> 0 AND n % 37 <> 0 THEN (CASE WHEN n % 71 = 0 THEN 'Infinity'::DOUBLE ELSE price END) END AS price,
    CASE WHEN n % 61 <> 0 THEN (CASE WHEN n % 41 = 0 THEN -quantity WHEN n % 73 = 0 THEN 1e30::DOUBLE ELSE quantity END) END AS quantity,
    CASE WHEN n % 61 <> 0 THEN (CASE WHEN n % 67 = 0 THEN quote_volume * CAST(1.01 AS DOUBLE) ELSE quote_volume END) END
      AS quote_volume,
    CASE WHEN n % 61 <> 0 THEN (CASE WHEN n % 53 = 0 THEN 'hold' ELSE side END) END AS side,
    CASE WHEN n % 61 <> 0 THEN date_trunc('millisecond', "timestamp") + to_seconds(shift) END AS "timestamp",
    CASE WHEN n % 61 <> 0 THEN date_trunc('millisecond', ingestion_timestamp) + to_seconds(shift) END
      AS ingestion_timestamp
  FROM dirty0),
rules AS (
  SELECT *,
    event_id IS NULL OR symbol IS NULL OR price IS NULL OR quantity IS NULL OR "timestamp" IS NULL AS r_incomplete,
    coalesce(price <= 0 OR quantity <= 0, false) OR coalesce(abs(price) >= 1e20, false) OR coalesce(abs(quantity) >= 1e20, false)
      OR coalesce(abs(price * quantity) >= 1e20, false) OR coalesce(abs(quote_volume) >= 1e20, false) AS r_range,
    symbol IS NOT NULL AND symbol NOT IN ('BTC-USDT', 'ETH-USDT', 'SOL-USDT') AS r_symbol,
    NOT coalesce(exchange IN ('binance', 'coinbase'), false) AS r_exchange,
    NOT coalesce(side IN ('buy', 'sell'), false) AS r_side,
    NOT coalesce(quote_volume < 5000000, false) AS r_notional,
    NOT coalesce(quantity >= 1, false) AS r_odd_lot
  FROM dirty),
flag0 AS (
  SELECT *,
    concat_ws(',', CASE WHEN malformed THEN 'malformed' END, CASE WHEN r_incomplete THEN 'incomplete' END,
      CASE WHEN r_range THEN 'invalid_range' END, CASE WHEN r_symbol THEN 'invalid_symbol' END,
      CASE WHEN r_exchange THEN 'invalid_exchange' END, CASE WHEN r_side THEN 'invalid_side' END,
      CASE WHEN r_notional THEN 'max_notional' END) AS failed_rules,
    CASE WHEN malformed THEN 'malformed' WHEN r_incomplete THEN 'incomplete'
      WHEN r_range OR r_symbol OR r_exchange OR r_side OR r_notional THEN 'invalid' END AS reason,
    coalesce(epoch_us(ingestion_timestamp) - epoch_us("timestamp") > 300000000, false) AS is_late,
    coalesce(abs(quote_volume - price * quantity) / CASE WHEN quote_volume <> 0 THEN quote_volume END >= 0.001, false)
      AS qv_warn
  FROM rules),
flagged AS (
  SELECT *, reason IS NULL AND coalesce(epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (
      PARTITION BY CASE WHEN reason IS NULL THEN exchange END, CASE WHEN reason IS NULL THEN symbol END,
                   CASE WHEN reason IS NULL THEN event_id END, CASE WHEN reason IS NOT NULL THEN key || failed_rules END
      ORDER BY "timestamp", ingestion_timestamp)) <= 3600000000, false) AS is_duplicate
  FROM flag0),
invalid AS (
  SELECT *, coalesce(strftime("timestamp", '%Y-%m-%d'), '{AS_OF_DAY}') AS dt FROM flagged WHERE reason IS NOT NULL)"""


def dirty_flagged(spark, sf, cfg=DQ_CFG):
    return Q.dq_flag(A.raw_dirty(spark, sf), cfg)


def _rules_str(df: DataFrame) -> DataFrame:
    return df.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@query("dq_schema")
def q_dq_schema(spark, sf):
    p = Q.dq_schema(A.raw_dirty(spark, sf))
    return p.select("key", F.array_contains("failed_rules", "malformed").alias("malformed"), "event_id", "exchange",
                    "symbol", "price", "quantity", "quote_volume", "side", "timestamp", "ingestion_timestamp")


sql("dq_schema", with_(TRADES_E, DIRTY) + """
SELECT key, malformed, event_id, exchange, symbol, price, quantity, quote_volume, side, "timestamp", ingestion_timestamp
FROM dirty""")


def _single_rule(spark, sf, fn):
    p = Q.dq_schema(A.raw_dirty(spark, sf)).withColumn("failed_rules", Q.empty())
    return _rules_str(fn(p)).select("key", "event_id", "timestamp", "failed_rules")


def _single_rule_sql(cond: str, name: str) -> str:
    return with_(TRADES_E, DIRTY) + f"""
SELECT key, event_id, "timestamp", CASE WHEN {cond} THEN '{name}' ELSE '' END AS failed_rules FROM rules"""


@query("dq_complete")
def q_dq_complete(spark, sf):
    return _single_rule(spark, sf, Q.dq_complete)


sql("dq_complete", _single_rule_sql("r_incomplete", "incomplete"))


@query("dq_valid_range")
def q_dq_valid_range(spark, sf):
    return _single_rule(spark, sf, Q.dq_valid_range)


sql("dq_valid_range", _single_rule_sql("r_range", "invalid_range"))


@query("dq_valid_symbol")
def q_dq_valid_symbol(spark, sf):
    return _single_rule(spark, sf, lambda d: Q.dq_valid_symbol(d, CFG["symbols"]))


sql("dq_valid_symbol", _single_rule_sql("r_symbol", "invalid_symbol"))


@query("dq_valid_exchange")
def q_dq_valid_exchange(spark, sf):
    return _single_rule(spark, sf, lambda d: Q.dq_valid_exchange(d, CFG["exchanges"]))


sql("dq_valid_exchange", _single_rule_sql("r_exchange", "invalid_exchange"))


@query("dq_valid_side")
def q_dq_valid_side(spark, sf):
    return _single_rule(spark, sf, Q.dq_valid_side)


sql("dq_valid_side", _single_rule_sql("r_side", "invalid_side"))


@query("dq_custom_rules")
def q_dq_custom_rules(spark, sf):
    p = Q.dq_schema(A.raw_dirty(spark, sf)).withColumn("failed_rules", Q.empty())
    r = Q.dq_custom_rules(p, DQ_CFG["quality"]["custom_rules"])
    return _rules_str(r).select("key", "event_id", "timestamp", "failed_rules",
                                F.concat_ws(",", "warnings").alias("warnings"))


sql("dq_custom_rules", with_(TRADES_E, DIRTY) + """
SELECT key, event_id, "timestamp", CASE WHEN r_notional THEN 'max_notional' ELSE '' END AS failed_rules,
  CASE WHEN r_odd_lot THEN 'odd_lot' ELSE '' END AS warnings FROM rules""")


@query("dq_late_flag")
def q_dq_late_flag(spark, sf):
    p = Q.dq_late_flag(A.trades_e(spark, sf))
    return p.select("event_id", "timestamp", "ingestion_timestamp", "is_late")


sql("dq_late_flag", with_(TRADES_E) + """
SELECT event_id, "timestamp", ingestion_timestamp,
  epoch_us(ingestion_timestamp) - epoch_us("timestamp") > 300000000 AS is_late FROM trades_e""")


@query("dq_consistency")
def q_dq_consistency(spark, sf):
    p = Q.dq_consistency(Q.dq_schema(A.raw_dirty(spark, sf)))
    return p.select("key", "event_id", "timestamp", "qv_warn")


sql("dq_consistency", with_(TRADES_E, DIRTY) + """
SELECT key, event_id, "timestamp", qv_warn FROM flag0""")

FLAG_COLS = ["key", "event_id", "timestamp", "reason", "failed_rules", "is_late", "qv_warn", "is_duplicate"]


@query("dq_validate")
def q_dq_validate(spark, sf):
    return _rules_str(dirty_flagged(spark, sf)).select(*FLAG_COLS)


sql("dq_validate", with_(TRADES_E, DIRTY) + f"SELECT {', '.join(chr(34) + c + chr(34) for c in FLAG_COLS)} FROM flagged")


@query("dq_dedup")
def q_dq_dedup(spark, sf):
    valid, _, _ = Q.dq_validate(A.raw_dirty(spark, sf), DQ_CFG, processing_date=AS_OF_DAY)
    return valid.select("key", "event_id", "exchange", "symbol", "price", "timestamp")


sql("dq_dedup", with_(TRADES_E, DIRTY) + """
SELECT key, event_id, exchange, symbol, price, "timestamp" FROM flagged WHERE reason IS NULL AND NOT is_duplicate""")


@query("dq_metrics")
def q_dq_metrics(spark, sf):
    return Q.dq_metrics(dirty_flagged(spark, sf))


sql("dq_metrics", with_(TRADES_E, DIRTY) + """
SELECT count(*) AS processed, count(*) FILTER (WHERE reason IS NULL AND NOT is_duplicate) AS passed,
  count(*) FILTER (WHERE reason IS NOT NULL) AS failed, count(*) FILTER (WHERE is_late) AS late,
  count(*) FILTER (WHERE is_duplicate) AS duplicate,
  round(100.0 * (count(*) - count(*) FILTER (WHERE reason IS NOT NULL)) / count(*), 6) AS quality_score_pct,
  round(100.0 * count(*) FILTER (WHERE reason IS NOT NULL) / count(*), 6) AS failure_pct
FROM flagged""")


@query("dq_score_series")
def q_dq_score_series(spark, sf):
    return Q.dq_score_series(dirty_flagged(spark, sf), "1 day")


sql("dq_score_series", with_(TRADES_E, DIRTY) + """
SELECT time_bucket(INTERVAL 1 DAY, "timestamp", TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 1 DAY, "timestamp", TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end,
  count(*) AS records, count(*) FILTER (WHERE reason IS NULL) AS passed, count(*) FILTER (WHERE reason IS NOT NULL) AS failed,
  round(100.0 * count(*) FILTER (WHERE reason IS NULL) / count(*), 6) AS pass_rate_pct,
  round(100.0 * count(*) FILTER (WHERE reason IS NOT NULL) / count(*), 6) AS fail_rate_pct
FROM flagged WHERE "timestamp" IS NOT NULL GROUP BY 1, 2""")


def dirty_invalid(spark, sf):
    _, invalid, _ = Q.dq_validate(A.raw_dirty(spark, sf), DQ_CFG, processing_date=AS_OF_DAY)
    return invalid


@query("dq_failure_breakdown")
def q_dq_failure_breakdown(spark, sf):
    return Q.dq_failure_breakdown(dirty_invalid(spark, sf))


sql("dq_failure_breakdown", with_(TRADES_E, DIRTY) + "SELECT reason, count(*) AS failures FROM invalid GROUP BY reason")


@query("dq_recent_failures")
def q_dq_recent_failures(spark, sf):
    return Q.dq_recent_failures(dirty_invalid(spark, sf), 20)


sql("dq_recent_failures", with_(TRADES_E, DIRTY) + """
SELECT key, event_id, "timestamp", reason, failed_rules FROM invalid
ORDER BY "timestamp" DESC NULLS LAST, key DESC, failed_rules DESC LIMIT 20""")


@query("dq_dlq_summary")
def q_dq_dlq_summary(spark, sf):
    return Q.dq_dlq_summary(dirty_invalid(spark, sf))


sql("dq_dlq_summary", with_(TRADES_E, DIRTY) + "SELECT dt, reason, count(*) AS records FROM invalid GROUP BY dt, reason")


@query("dq_stream_gap")
def q_dq_stream_gap(spark, sf):
    return Q.dq_stream_gap(A.trades_e(spark, sf), 3600)


sql("dq_stream_gap", with_(TRADES_E) + """,
seen AS (SELECT DISTINCT exchange, symbol, (epoch_us("timestamp") // 3600000000) * 3600000000 AS ws FROM trades_e),
b AS (SELECT DISTINCT exchange, symbol, (SELECT min(ws) FROM seen) AS lo, (SELECT max(ws) FROM seen) AS hi FROM seen),
cal AS (SELECT exchange, symbol, unnest(range(lo, hi + 1, 3600000000)) AS ws FROM b)
SELECT c.exchange, c.symbol, make_timestamp(c.ws) AS window_start, make_timestamp(c.ws + 3600000000) AS window_end
FROM cal c ANTI JOIN seen s ON c.exchange = s.exchange AND c.symbol = s.symbol AND c.ws = s.ws""")


@query("dq_feed_staleness")
def q_dq_feed_staleness(spark, sf):
    return Q.dq_feed_staleness(A.trades_e(spark, sf))


sql("dq_feed_staleness", with_(TRADES_E) + """,
l AS (SELECT exchange, max("timestamp") AS last_seen FROM trades_e GROUP BY exchange),
m AS (SELECT max("timestamp") AS as_of FROM trades_e)
SELECT exchange, last_seen, (epoch_us(as_of) - epoch_us(last_seen)) / 1000000 AS age_seconds,
  epoch_us(as_of) - epoch_us(last_seen) < 30000000 AS healthy FROM l, m""")


@query("dq_batch_gate")
def q_dq_batch_gate(spark, sf):
    valid, _, _ = Q.dq_validate(A.raw_dirty(spark, sf), DQ_CFG, processing_date=AS_OF_DAY)
    expected = A.trades_e(spark, sf).select(*TRADE_COLS).schema
    return Q.dq_batch_gate(valid, expected, min_rows=100)


sql("dq_batch_gate", with_(TRADES_E, DIRTY) + """
SELECT count(*) AS row_count, true AS schema_ok, count(*) >= 100 AS passed,
  CASE WHEN count(*) < 100 THEN 'too_few_rows' ELSE '' END AS reasons
FROM flagged WHERE reason IS NULL AND NOT is_duplicate""")
