"""MOD-005 wallet labels: registry refresh, enrichment, alerts.
The join strategy is left to the planner and AQE, which see measured bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.operators.alerts import alert_build

LABEL_COLS = ["wallet", "label", "entity_type"]


def label_refresh(old: DataFrame, new: DataFrame, key: str = "wallet") -> DataFrame:
    """Daily upsert: every wallet of either side, the new row wins."""
    o = old.select(key, *[F.col(c).alias("old_" + c) for c in LABEL_COLS if c != key])
    n = new.select(key, *[F.col(c).alias("new_" + c) for c in LABEL_COLS if c != key])
    j = o.join(n, key, "full")
    return j.select(key, *[F.coalesce("new_" + c, "old_" + c).alias(c) for c in LABEL_COLS if c != key],
                    F.when(F.col("new_label").isNull(), "kept")
                    .when(F.col("old_label").isNull(), "added")
                    .when(F.col("old_label") == F.col("new_label"), "unchanged")
                    .otherwise("updated").alias("change"))


def label_enrich(df: DataFrame, labels: DataFrame, key: str = "wallet") -> DataFrame:
    """Left join of transactions to the registry."""
    lab = labels.select(F.col("wallet").alias(key), "label", "entity_type")
    return df.join(lab, key, "left")


def label_alerts(df: DataFrame, labels: DataFrame, usd: float = 100000, high_usd: float = 500000,
                 key: str = "wallet") -> DataFrame:
    """``known_whale_activity`` for trades above ``usd`` by labelled wallets."""
    lab = labels.select(F.col("wallet").alias(key), "label", "entity_type")
    j = df.where(F.col("quote_volume") > F.lit(usd)).join(lab, key)
    j = j.withColumn("severity", F.when(F.col("quote_volume") > F.lit(high_usd), "high").otherwise("medium"))
    msg = F.format_string("Labelled wallet %s (%s) traded %d USD of %s", F.col(key).cast("string"), F.col("label"),
                          F.floor("quote_volume").cast("long"), F.col("symbol"))
    return alert_build(j, "MOD-005", "known_whale_activity", "severity", msg,
                       details_cols=[("wallet", F.col(key).cast("string")), "label", "entity_type", "quote_volume",
                                     "side", "event_id"],
                       id_cols=["event_id", F.col(key)], detected_at="ts")
