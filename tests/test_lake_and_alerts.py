"""Reconcile statuses, registry check of unknown types, retention, TTL."""

from pyspark.sql import functions as F

from tradewatch.operators.alerts import alert_registry_check, alert_ttl
from tradewatch.plans.lake import governed_view, reconcile, retention, table_ddl


def test_reconcile_statuses(spark):
    old = spark.createDataFrame([("a", "high", 1), ("b", "medium", 2), ("c", "low", 3)], "alert_id string, sev string, n int")
    new = spark.createDataFrame([("a", "high", 1), ("b", "high", 2), ("d", "low", 4)], "alert_id string, sev string, n int")
    got = {r.alert_id: (r.status, r.changed_columns) for r in reconcile(old, new).collect()}
    assert got == {"a": ("same", ""), "b": ("changed", "sev"), "c": ("missing", ""), "d": ("new", "")}


def test_registry_marks_unknown_types(spark):
    rows = [("1", "whale_trade", "MOD-002", "BTC-USDT", "binance", "critical", "2024-01-01 00:00:00", "m", 0, "{}"),
            ("2", "volume_spike", "MOD-001", "BTC-USDT", "binance", "critical", "2024-01-01 00:00:00", "m", 0, "{}"),
            ("3", "brand_new_type", "MOD-099", "BTC-USDT", None, "low", "2024-01-01 00:00:00", "m", 0, "{}")]
    df = spark.createDataFrame(rows, "alert_id string, alert_type string, module_id string, symbol string, "
                                     "exchange string, severity string, detected_at string, message string, "
                                     "ttl_epoch long, details string").withColumn("detected_at", F.to_timestamp("detected_at"))
    got = {r.alert_id: (r.registered, r.severity_ok) for r in alert_registry_check(df).collect()}
    assert got == {"1": (True, True), "2": (True, False), "3": (False, False)}


def test_ttl_retention_and_governance(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", "x"), ("b", "2024-01-02 12:00:00", "y")],
                               "alert_id string, detected_at string, message string") \
        .withColumn("detected_at", F.to_timestamp("detected_at"))
    live = {r.alert_id for r in alert_ttl(df, "2024-01-02 06:00:00").collect()}
    assert live == {"b"}
    kept = {r.alert_id for r in retention(df, "detected_at", "2024-01-03 00:00:00", 1).collect()}
    assert kept == {"b"}
    assert governed_view(df, "analyst", {"analyst": ["message"]}).columns == ["alert_id", "detected_at"]
    ddl = table_ddl(df.schema, "anomaly_alerts", ["dt"])
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS anomaly_alerts") and "PARTITIONED BY (dt)" in ddl
