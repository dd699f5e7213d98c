"""Registered queries: all eleven modules in one run, with the lineage of every
alert (SURVEY 2.3, 2.11). Wallet trades are laid over the days of ``events``, on-chain
events and swaps keep their own dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewatch.config import MODULES
from tradewatch.operators import alerts as AL
from tradewatch.operators import lineage as L
from tradewatch.operators.lineage import lin_config_hash
from tradewatch.plans.modules import run_modules
from tradewatch.sources import adapters as A
from tradewatch.suite import chain, forecast, identity
from tradewatch.suite.oracle import SQL, TRADES_E, WALLET_LABELS, WALLET_LIVE, with_
from tradewatch.suite.registry import PROCESSED_AT, query, sql
from tradewatch.suite.serve import BASE, BASE_SQL, RUN_CFG, RUN_SQL

SECTION = {"MOD-001": "volume_anomaly", "MOD-002": "whale_detector", "MOD-003": "spread_calculator", "MOD-004": "wallet_scorer",
           "MOD-005": "labels", "MOD-006": "flow", "MOD-007": "consensus", "MOD-008": "onchain", "MOD-009": "dex",
           "MOD-010": "predictive", "MOD-011": "backtest"}
SOURCE = {"MOD-004": "wallet_trades", "MOD-005": "wallet_trades", "MOD-008": "onchain_events", "MOD-009": "dex_trades",
          "MOD-010": "predictive_scores", "MOD-011": "backtest_results"}


def all_modules(spark, sf):
    inputs = {"wallet_trades": A.wallet_trades_live(spark, sf), "labels": A.wallet_labels(spark, sf),
              "onchain": chain.events(spark, sf), "swaps": chain.swaps(spark, sf)}
    return AL.alert_union(*run_modules(A.trades_e(spark, sf), RUN_CFG, tuple(MODULES), PROCESSED_AT, inputs).values())


LIVE = with_(WALLET_LIVE + "," + identity.period_sql("wallet_live", 3, 5))
DIRECTED = f"""
  UNION ALL
  SELECT alert_id, module_id, alert_type, symbol, detected_at, CASE WHEN alert_type IN ('accumulation_signal', 'consensus_bullish') THEN 1
    WHEN alert_type IN ('distribution_signal', 'consensus_bearish') THEN -1 END
  FROM ({SQL["run_modules"]}) WHERE module_id IN ('MOD-003', 'MOD-006', 'MOD-007')"""
PARTS = [
    SQL["run_modules"],
    LIVE + identity.HIGH_SQL, LIVE + identity.CHANGE_SQL,
    with_(WALLET_LIVE, WALLET_LABELS) + identity.LABEL_SQL.replace("wallet_trades t", "wallet_live t"),
    SQL["onchain_swap_filter"], SQL["onchain_large_transfer"], SQL["dex_large_swaps"], SQL["dex_liquidity_change"], SQL["pred_alerts"],
    with_(TRADES_E) + forecast.bt_sql(DIRECTED) + forecast.COMPLETE_SQL, with_(TRADES_E) + forecast.bt_sql(DIRECTED) + forecast.DEGRADATION_SQL,
]
ALL_SQL = "\nUNION ALL\n".join(f"SELECT {BASE_SQL} FROM ({p})" for p in PARTS)


def _case(values: dict, default: str) -> str:
    return "CASE module_id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE '{default}' END"


@query("run_modules_all")
def q_run_modules_all(spark, sf):
    """Every alert of the eleven modules with its lineage; the ids of source rows are told as present."""
    a = L.lineage_rows(all_modules(spark, sf), keep=("severity", "message", "ttl_epoch"))
    return a.select(*BASE, "source_table", "lineage_module_id", "detector_name", "config_hash", "processed_at", "pipeline_version",
                    (F.length("correlation_id") == 16).alias("has_correlation"), (F.length("source_event_id") > 0).alias("has_event"))


sql("run_modules_all", f"""
SELECT {BASE_SQL}, {_case(SOURCE, 'raw_trades')} AS source_table, module_id AS lineage_module_id, {_case(MODULES, '')} AS detector_name,
  {_case({m: lin_config_hash(RUN_CFG[s]) for m, s in SECTION.items()}, '')} AS config_hash, '{PROCESSED_AT}' AS processed_at,
  'dev' AS pipeline_version, true AS has_correlation, true AS has_event
FROM ({ALL_SQL})""")


@query("lin_trace_windows")
def q_lin_trace_windows(spark, sf):
    """Alerts of the trade-stream modules, and how many raw trades each is traced to: one."""
    t = A.trades_e(spark, sf)
    a = AL.alert_union(*run_modules(t, RUN_CFG, ("MOD-007", "MOD-003"), PROCESSED_AT).values())
    traced = L.lin_trace_raw(a, t).groupBy("alert_id").agg(F.count(F.lit(1)).alias("n"))
    return a.select("alert_id", "alert_type").join(traced, "alert_id", "left").select("alert_id", "alert_type", F.coalesce("n", F.lit(0)).alias("traced"))


sql("lin_trace_windows", RUN_SQL + "\nSELECT alert_id, alert_type, CAST(1 AS BIGINT) AS traced FROM run_all")
