"""The flagship slice used by ``entry``: every layer once, no window state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.operators import lineage as L
from tradewatch.operators import quality as Q
from tradewatch.operators.alerts import alert_ttl
from tradewatch.operators.whale import whale_alerts, whale_detect
from tradewatch.session import prepare
from tradewatch.sources import adapters as A

PROCESSED_AT = "2024-02-01T00:00:00.000Z"


def flagship(spark: SparkSession, sf_dir: str, cfg: dict | None = None) -> DataFrame:
    prepare(spark)
    cfg = cfg or make_config()
    valid, _, _ = Q.dq_validate(A.trades_e(spark, sf_dir), cfg, parse=False, processing_date="2024-02-01")
    whales = L.with_correlation_id(whale_detect(valid, cfg))
    whales = L.lin_attach(whales, "MOD-002", "whale-detector", cfg["whale_detector"], PROCESSED_AT)
    alerts = whale_alerts(whales, cfg)
    clock = alerts.agg(F.max("detected_at")).scalar()  # scalar subquery: computed once
    return alert_ttl(alerts, clock - F.expr("INTERVAL 7 DAYS"))
