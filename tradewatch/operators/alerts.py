"""Base alerts: build, id, TTL, union, registry check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.config import ALERT_REGISTRY
from tradewatch.functions.columns import alert_id

ALERT_COLUMNS = ["alert_id", "alert_type", "module_id", "symbol", "exchange", "severity", "detected_at", "message",
                 "ttl_epoch", "details"]
ALERT_SCHEMA = ", ".join(c + {"detected_at": " timestamp", "ttl_epoch": " long"}.get(c, " string") for c in ALERT_COLUMNS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alert_build(df: DataFrame, module_id: str, alert_type, severity="severity", message=None,
                details_cols=(), id_cols=(), detected_at="detected_at", exchange="exchange", symbol="symbol",
                ttl_hours: int = 24) -> DataFrame:
    """Any detector row -> the 10 base alert columns. ``details`` is a JSON
    object of ``details_cols`` (name or (name, Column)) plus ``_lineage`` when
    the row carries it. The alert id hashes type, exchange, symbol and
    ``id_cols`` so the same finding always gets the same id."""
    atype = F.lit(alert_type) if isinstance(alert_type, str) else alert_type
    exch = F.lit(None).cast("string") if exchange is None else _col(exchange)
    fields = []
    for d in details_cols:
        if isinstance(d, tuple):
            fields.append(_col(d[1]).alias(d[0]))
        else:
            fields.append(F.col(d))
    if "_lineage" in df.columns:
        fields.append(F.col("_lineage"))
    details = F.to_json(F.struct(*fields)) if fields else F.lit("{}")
    det = _col(detected_at).cast("timestamp")
    msg = F.lit(None).cast("string") if message is None else _col(message)
    return df.select(
        alert_id(atype, exch, _col(symbol), *[_col(c) for c in id_cols]).alias("alert_id"),
        atype.alias("alert_type"),
        F.lit(module_id).alias("module_id"),
        _col(symbol).cast("string").alias("symbol"),
        exch.alias("exchange"),
        _col(severity).alias("severity"),
        det.alias("detected_at"),
        msg.alias("message"),
        (F.unix_seconds(det) + F.lit(ttl_hours * 3600)).alias("ttl_epoch"),
        details.alias("details"),
    )


def alert_ttl(alerts: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Recompute ttl_epoch = detected_at + hours and drop alerts expired at
    ``as_of`` (timestamp literal or Column)."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    out = alerts.withColumn("ttl_epoch", F.unix_seconds("detected_at") + F.lit(hours * 3600))
    return out.where(F.col("ttl_epoch") > F.unix_seconds(as_of_col))


def alert_union(*alerts: DataFrame) -> DataFrame:
    """All module alerts in one frame; the type set stays open."""
    return reduce(lambda a, b: a.unionByName(b), [a.select(*ALERT_COLUMNS) for a in alerts])


def registry_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALERT_REGISTRY, "reg_alert_type string, reg_module_id string, severities string")


def alert_registry_check(alerts: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Mark each alert as registered and its severity as allowed; unknown types
    pass through with registered = false. The registry has 18 rows (a fixed
    bound), so it is broadcast."""
    reg = registry if registry is not None else registry_frame(alerts.sparkSession)
    j = alerts.join(F.broadcast(reg), alerts.alert_type == reg.reg_alert_type, "left")
    return j.select(
        *[alerts[c] for c in ALERT_COLUMNS],
        F.col("reg_alert_type").isNotNull().alias("registered"),
        F.coalesce(F.array_contains(F.split("severities", ","), F.col("severity")), F.lit(False)).alias("severity_ok"),
        (F.col("reg_module_id") == F.col("module_id")).alias("module_ok"),
    )
