"""Registered queries: sources, sinks and lakehouse operations (SURVEY 2.1,
2.11 sinks, 2.13). Each writes the whole input to the shared checkpoint
folder (``spark.checkpoint.dir``) and reads it back."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.functions.columns import stable_round
from tradewatch.operators.whale import whale_alerts, whale_detect
from tradewatch.plans import lake as LK
from tradewatch.plans import sinks as SK
from tradewatch.plans.files import exists, signature
from tradewatch.session import scratch_path
from tradewatch.sources import adapters as A
from tradewatch.sources import trades as TR
from tradewatch.sources.tables import TABLES
from tradewatch.suite import core
from tradewatch.suite.core import TRADE_COLS, WHALE_ALERTS_SQL, whales_with_lineage
from tradewatch.suite.oracle import TRADES_E, sround, with_
from tradewatch.suite.registry import PROCESSED_AT, query, sql
from tradewatch.suite.serve import BASE, BASE_SQL, SMALL_SQL, RUN_CFG, small_alerts

CUT = "2024-01-20 00:00:00"
FIXTURE_VERSION = "v3"


def _tag(spark, sf: str) -> str:
    """Names a data folder by its files' sizes and change times, so that changed data gets new fixtures."""
    tables = [(t, signature(spark, os.path.join(sf, f"{t}.parquet"))) for t in TABLES]
    return hashlib.sha1(repr((sf, tables)).encode()).hexdigest()[:10]


def fixture(spark, sf, name, build) -> str:
    """The path of a derived table, written by ``build(path)`` once per data folder; one
    that was cut short (no success marker) is written again."""
    path = scratch_path(spark, "fixtures", FIXTURE_VERSION, _tag(spark, sf), name)
    if not exists(spark, os.path.join(path, "_SUCCESS")):
        build(path)
    return path


def fresh(spark, name):
    return scratch_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


def raw_trades_table(spark, sf) -> str:
    """trades_e as the raw_trades table partitioned by (date, symbol);
    written once per data folder."""
    def build(path):
        t = A.trades_e(spark, sf).withColumn("date", F.to_date("timestamp"))
        t.write.mode("overwrite").partitionBy("date", "symbol").parquet(path)
    return fixture(spark, sf, "raw_trades", build)


# ---- 2.1 sources ---------------------------------------------------------------------------------

@query("src_trades_batch")
def q_src_trades_batch(spark, sf):
    df = TR.read_trades(spark, raw_trades_table(spark, sf), "2024-01-05", "2024-01-20", ["BTC-USDT", "ETH-USDT"])
    return df.select(*TRADE_COLS)


sql("src_trades_batch", with_(TRADES_E) + f"""
SELECT {', '.join(chr(34) + c + chr(34) for c in TRADE_COLS)} FROM trades_e
WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-20' AND symbol IN ('BTC-USDT', 'ETH-USDT')""")


@query("src_agg_trades")
def q_src_agg_trades(spark, sf):
    """A per-pair dump folder (CSV) of venue A trades, loaded per pair."""
    def build(path):
        t = A.trades_e(spark, sf)
        dump = t.select(F.regexp_replace("symbol", "-", "").alias("pair"),
                        F.col("event_id").cast("long").alias("agg_trade_id"), F.col("price").cast("string").alias("price"),
                        F.col("quantity").cast("string").alias("quantity"),
                        F.col("event_id").cast("long").alias("first_trade_id"),
                        F.col("event_id").cast("long").alias("last_trade_id"),
                        F.unix_millis("timestamp").alias("transact_time"),
                        (F.col("side") == "sell").alias("is_buyer_maker"))
        dump.write.mode("overwrite").partitionBy("pair").option("header", True).csv(path)
    path = fixture(spark, sf, "agg_dump", build)
    parts = [TR.load_agg_trades(TR.read_agg_dump(spark, os.path.join(path, f"pair={p}")), p, ingested_at=core.INGESTED_AT)
             for p in ("BTCUSDT", "ETHUSDT", "SOLUSDT")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


sql("src_agg_trades", with_(TRADES_E) + f"""
SELECT event_id, 'binance' AS exchange, symbol, price, quantity, quote_volume, side,
  make_timestamp((epoch_us("timestamp") // 1000) * 1000) AS "timestamp", strftime("timestamp", '%Y-%m-%d') AS date,
  TIMESTAMP '{core.INGESTED_AT}' AS ingestion_timestamp FROM trades_e""")


@query("src_label_files")
def q_src_label_files(spark, sf):
    base = fresh(spark, "labels")
    csv_p, json_p = os.path.join(base, "csv"), os.path.join(base, "json")
    A.wallet_labels(spark, sf).write.mode("overwrite").option("header", True).csv(csv_p)
    cu = A.table(spark, sf, "customer")
    cu.where(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.col("c_custkey").alias("wallet"), F.concat(F.col("c_name"), F.lit("-v2")).alias("label"),
        F.col("c_mktsegment").alias("entity_type")).write.mode("overwrite").json(json_p)
    return TR.load_labels(spark, [csv_p], [json_p])


sql("src_label_files", """
WITH o AS (SELECT c_custkey AS wallet, c_name AS label, c_mktsegment AS entity_type FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
n AS (SELECT c_custkey AS wallet, c_name || '-v2' AS label, c_mktsegment AS entity_type FROM customer
      WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD'))
SELECT wallet, label, entity_type FROM n
UNION ALL
SELECT wallet, label, entity_type FROM o WHERE wallet NOT IN (SELECT wallet FROM n)""")


# ---- sinks ------------------------------------------------------------------------------------------

@query("sink_partitioned")
def q_sink_partitioned(spark, sf):
    path = fresh(spark, "anomaly_alerts")
    SK.sink_partitioned(small_alerts(spark, sf), path)
    back = spark.read.parquet(path)
    return back.select(*BASE, F.col("dt").cast("string").alias("dt"))


sql("sink_partitioned", SMALL_SQL + f"\nSELECT {BASE_SQL}, strftime(detected_at, '%Y-%m-%d') AS dt FROM small")


@query("sink_upsert")
def q_sink_upsert(spark, sf):
    """Two overlapping batches (first three weeks, then everything) upserted
    into one keyed table: every alert once."""
    path = fresh(spark, "whale_hot")
    alerts = whale_alerts(whales_with_lineage(spark, sf))
    SK.sink_upsert(alerts.where(F.col("detected_at") < F.lit(CUT).cast("timestamp")), path)
    SK.sink_upsert(alerts, path)
    back = spark.read.parquet(path)
    return back.select("alert_id", "alert_type", "severity", F.col("dt").cast("string").alias("dt"))


sql("sink_upsert", with_(TRADES_E, WHALE_ALERTS_SQL) + """
SELECT alert_id, alert_type, severity, strftime(detected_at, '%Y-%m-%d') AS dt FROM whale_alerts""")


@query("sink_dlq")
def q_sink_dlq(spark, sf):
    path = fresh(spark, "dlq")
    SK.sink_dlq(core.dirty_invalid(spark, sf), path)
    back = spark.read.parquet(path)
    return back.select("key", "event_id", "reason", F.col("dt").cast("string").alias("dt"))


sql("sink_dlq", with_(TRADES_E, core.DIRTY) + "SELECT key, event_id, reason, dt FROM invalid")


@query("route_alerts")
def q_route_alerts(spark, sf):
    hot, cold = fresh(spark, "hot"), fresh(spark, "cold")
    a = small_alerts(spark, sf)
    SK.route_alerts(a, hot, cold)
    hot_df = spark.read.parquet(hot)
    clock = hot_df.agg(F.max("detected_at")).scalar()  # scalar subquery
    live = hot_df.where(F.col("ttl_epoch") > F.unix_seconds(clock))
    return live.select(F.lit("hot").alias("store"), "alert_id").unionByName(
        spark.read.parquet(cold).select(F.lit("cold").alias("store"), "alert_id"))


sql("route_alerts", SMALL_SQL + """,
clk AS (SELECT max(detected_at) AS as_of FROM small)
SELECT 'hot' AS store, alert_id FROM small, clk WHERE ttl_epoch > epoch_us(as_of) // 1000000
UNION ALL
SELECT 'cold', alert_id FROM small""")


# ---- 2.13 lake ---------------------------------------------------------------------------------------

def snapshots(spark, sf) -> str:
    """trades_e as two commits: v1 before CUT, v2 the rest."""
    path = fresh(spark, "raw_trades_snap")
    t = A.trades_e(spark, sf).withColumn("date", F.to_date("timestamp"))
    cut = F.lit(CUT).cast("timestamp")
    LK.snapshot_write(t.where(F.col("timestamp") < cut), path, 1, "2024-01-20 00:00:00")
    LK.snapshot_write(t.where(F.col("timestamp") >= cut), path, 2, "2024-02-01 00:00:00")
    return path


TRADES_V1 = TRADES_E.replace("  FROM events)", f"  FROM events WHERE ts < TIMESTAMP '{CUT}')", 1)


@query("snapshot_read")
def q_snapshot_read(spark, sf):
    s = LK.snapshot_read(spark, snapshots(spark, sf), version=1)
    return s.select(*TRADE_COLS, "commit_id")


sql("snapshot_read", with_(TRADES_V1) + f"""
SELECT {', '.join(chr(34) + c + chr(34) for c in TRADE_COLS)}, CAST(1 AS BIGINT) AS commit_id FROM trades_e""")


@query("reprocess")
def q_reprocess(spark, sf):
    snap = LK.snapshot_read(spark, snapshots(spark, sf), timestamp="2024-01-25 00:00:00")
    return LK.reprocess(snap, RUN_CFG, ("MOD-001", "MOD-002", "MOD-003"), PROCESSED_AT).select(*BASE)


sql("reprocess", SMALL_SQL.replace(TRADES_E, TRADES_V1, 1) + f"\nSELECT {BASE_SQL} FROM small")


@query("reconcile")
def q_reconcile(spark, sf):
    """Original run: snapshot v1 with a 400K high-severity bound; reprocessed
    run: all data with the current 500K bound."""
    path = snapshots(spark, sf)
    old_cfg = make_config({"whale_detector": {"severity_high_usd": 400000}})
    old = whale_alerts(whale_detect(LK.snapshot_read(spark, path, version=1), old_cfg))
    new = whale_alerts(whale_detect(LK.snapshot_read(spark, path), make_config()))
    return LK.reconcile(old.select(*BASE), new.select(*BASE))


sql("reconcile", with_(TRADES_E) + f""",
w AS (SELECT *, CASE WHEN quote_volume > 1000000 THEN 'critical' WHEN quote_volume > 500000 THEN 'high'
        ELSE 'medium' END AS sev_new,
        CASE WHEN quote_volume > 1000000 THEN 'critical' WHEN quote_volume > 400000 THEN 'high'
        ELSE 'medium' END AS sev_old
      FROM trades_e WHERE quote_volume > 100000)
SELECT {core.alert_id("'whale_trade'", 'exchange', 'symbol', 'event_id')} AS alert_id,
  CASE WHEN "timestamp" >= TIMESTAMP '{CUT}' THEN 'new' WHEN sev_new <> sev_old THEN 'changed' ELSE 'same' END AS status,
  CASE WHEN "timestamp" >= TIMESTAMP '{CUT}' THEN '' WHEN sev_new <> sev_old THEN 'severity' ELSE '' END
    AS changed_columns
FROM w""")


@query("swap_if_valid")
def q_swap_if_valid(spark, sf):
    path = snapshots(spark, sf)
    old = whale_alerts(whale_detect(LK.snapshot_read(spark, path, version=1), make_config()))
    new_path = fresh(spark, "whale_reprocessed")
    whale_alerts(whale_detect(LK.snapshot_read(spark, path), make_config())).write.parquet(new_path)
    diff = LK.reconcile(old.select(*BASE), spark.read.parquet(new_path).select(*BASE))
    pointers = fresh(spark, "pointers")
    # the new commit adds more than a tenth of the rows: the strict gate keeps the old table, the loose one swaps
    strict = LK.swap_if_valid(spark, pointers, "strict", new_path, diff, 0.1)
    loose = LK.swap_if_valid(spark, pointers, "loose", new_path, diff, 0.9)
    tables = {n: LK.current_table(spark, pointers, n) for n in ("strict", "loose")}
    served = [spark.createDataFrame([(n, 0)], "name string, served long") if t is None else
              t.agg(F.count(F.lit(1)).alias("served")).select(F.lit(n).alias("name"), "served") for n, t in tables.items()]
    return strict.unionByName(loose).join(served[0].unionByName(served[1]), "name")


sql("swap_if_valid", with_(TRADES_E, WHALE_ALERTS_SQL) + f""",
c AS (SELECT count(*) FILTER (WHERE detected_at >= TIMESTAMP '{CUT}') AS differing, count(*) AS compared FROM whale_alerts),
g AS (SELECT 'strict' AS name, 0.1 AS share UNION ALL SELECT 'loose', 0.9)
SELECT name, differing, compared, differing <= compared * share AS passed,
  CASE WHEN differing <= compared * share THEN compared ELSE 0 END AS served FROM c, g""")


@query("evolve_add_column")
def q_evolve_add_column(spark, sf):
    path = fresh(spark, "evolve")
    table = "tw_evolve_" + uuid.uuid4().hex[:8]
    t = A.trades_e(spark, sf).select(*TRADE_COLS)
    cut = F.lit(CUT).cast("timestamp")
    t.where(F.col("timestamp") < cut).write.parquet(path)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    LK.evolve_add_column(spark, table, "venue_fee", "DOUBLE")
    t.where(F.col("timestamp") >= cut).withColumn("venue_fee", F.col("quote_volume") * F.lit(0.001)) \
        .write.insertInto(table)
    out = spark.table(table).select("event_id", "quote_volume", "venue_fee")
    spark.sql(f"DROP TABLE {table}")  # the catalog entry; the files are the caller's
    return out


sql("evolve_add_column", with_(TRADES_E) + f"""
SELECT event_id, quote_volume, CASE WHEN "timestamp" >= TIMESTAMP '{CUT}' THEN quote_volume * 0.001 END AS venue_fee
FROM trades_e""")


@query("evolve_partition")
def q_evolve_partition(spark, sf):
    old_p, new_p = fresh(spark, "daily"), fresh(spark, "hourly")
    t = A.trades_e(spark, sf).select(*TRADE_COLS).withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    cut = F.lit(CUT).cast("timestamp")
    t.where(F.col("timestamp") < cut).write.partitionBy("date").parquet(old_p)
    t.where(F.col("timestamp") >= cut).withColumn("hour", F.hour("timestamp")).write.partitionBy("date", "hour") \
        .parquet(new_p)
    u = LK.evolve_partition(spark, old_p, new_p)
    return u.select("event_id", F.col("date").cast("string").alias("date"), F.col("hour").cast("string").alias("hour"))


sql("evolve_partition", with_(TRADES_E) + f"""
SELECT event_id, strftime("timestamp", '%Y-%m-%d') AS date,
  CASE WHEN "timestamp" >= TIMESTAMP '{CUT}' THEN CAST(hour("timestamp") AS VARCHAR) END AS hour FROM trades_e""")


@query("table_ddl")
def q_table_ddl(spark, sf):
    """CREATE TABLE text for the main tables, each with its row count."""
    from tradewatch.suite import detect
    tables = {
        "raw_trades": (A.trades_e(spark, sf).withColumn("date", F.to_date("timestamp")), ("date", "symbol")),
        "anomaly_alerts": (SK.with_day(small_alerts(spark, sf), "detected_at"), ("dt", "alert_type")),
        "exchange_spreads": (detect.spreads(spark, sf), ("symbol",)),
    }
    parts = []
    for name, (df, pcols) in tables.items():
        ddl = LK.table_ddl(df.schema, name, pcols)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"),
                                                                     F.lit(ddl).alias("ddl"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("table_stats")
def q_table_stats(spark, sf):
    table = "tw_raw_trades_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{raw_trades_table(spark, sf)}'")
    stats = LK.table_stats(spark, table)
    spark.sql(f"DROP TABLE {table}")
    number = F.when(F.col("column_name").isin("price", "quantity", "quote_volume"), F.col("min_value").try_cast("double"))
    top = F.when(F.col("column_name").isin("price", "quantity", "quote_volume"), F.col("max_value").try_cast("double"))
    return stats.select("column_name", "row_count", "null_count", stable_round(number, 6).alias("min_number"), stable_round(top, 6).alias("max_number"))


sql("table_stats", with_(TRADES_E) + " UNION ALL ".join(
    f"""
SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count("{c}") AS null_count,
  {sround(f'min("{c}")', 6) if c in ("price", "quantity", "quote_volume") else 'NULL::DOUBLE'} AS min_number,
  {sround(f'max("{c}")', 6) if c in ("price", "quantity", "quote_volume") else 'NULL::DOUBLE'} AS max_number FROM trades_e"""
    for c in ("event_id", "exchange", "price", "quantity", "quote_volume", "side", "timestamp", "ingestion_timestamp")))


@query("retention")
def q_retention(spark, sf):
    a = small_alerts(spark, sf)
    return LK.retention(a, "detected_at", a.agg(F.max("detected_at")).scalar(), 7).select(*BASE)


sql("retention", SMALL_SQL + f""",
clk AS (SELECT max(detected_at) AS as_of FROM small)
SELECT {BASE_SQL} FROM small, clk WHERE detected_at > as_of - INTERVAL 7 DAY""")


@query("governed_view")
def q_governed_view(spark, sf):
    restricted = {"analyst": ["message", "details", "ttl_epoch"], "admin": []}
    return LK.governed_view(small_alerts(spark, sf), "analyst", restricted)


sql("governed_view", SMALL_SQL + """
SELECT alert_id, alert_type, module_id, symbol, exchange, severity, detected_at FROM small""")
