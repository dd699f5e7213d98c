"""MOD-002 whale trades: a stateless filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.operators.alerts import alert_build


def whale_filter(df: DataFrame, usd: float = 100000) -> DataFrame:
    """Trades with quote_volume strictly above ``usd`` (R6)."""
    return df.where(F.col("quote_volume") > F.lit(usd))


def whale_severity(df: DataFrame, high: float = 500000, critical: float = 1000000) -> DataFrame:
    qv = F.col("quote_volume")
    return df.withColumn("severity", F.when(qv > F.lit(critical), "critical").when(qv > F.lit(high), "high")
                         .otherwise("medium"))


def whale_detect(df: DataFrame, cfg: dict) -> DataFrame:
    c = cfg["whale_detector"]
    return whale_severity(whale_filter(df, c["min_quote_volume_usd"]), c["severity_high_usd"],
                          c["severity_critical_usd"])


def whale_alerts(whales: DataFrame, cfg: dict | None = None) -> DataFrame:
    """``whale_trade`` alerts (one per whale trade, detected at trade time)."""
    msg = F.format_string("Whale %s of %d USD on %s %s", F.col("side"),
                          F.floor("quote_volume").cast("long"), F.col("exchange"), F.col("symbol"))
    return alert_build(whales, "MOD-002", "whale_trade", "severity", msg,
                       details_cols=["quote_volume", "price", "quantity", "side", "event_id"],
                       id_cols=["event_id"], detected_at="timestamp")
