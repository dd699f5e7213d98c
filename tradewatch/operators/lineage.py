"""Lineage: correlation ids, config hash, the ``_lineage`` object."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.columns import iso_ms, lin_correlation_id

# The eight lineage fields of an alert, in order.
LINEAGE_FIELDS = ["correlation_id", "source_table", "source_event_id", "module_id", "detector_name",
                  "config_hash", "processed_at", "pipeline_version"]


def lin_config_hash(cfg: dict) -> str:
    """sha256 of the compact, key-sorted JSON of a config (64 hex chars)."""
    text = json.dumps(cfg, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def with_correlation_id(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add ``correlation_id`` from exchange, symbol and ISO-ms event time."""
    return df.withColumn("correlation_id", lin_correlation_id("exchange", "symbol", iso_ms(ts_col)))


def lin_attach(df: DataFrame, module_id: str, detector_name: str, cfg: dict, processed_at: str,
               pipeline_version: str = "dev", source_table: str = "raw_trades",
               event_col: str = "event_id", correlation_col: str = "correlation_id") -> DataFrame:
    """Add the 8-field ``_lineage`` struct (serialised by alert_build)."""
    lineage = F.struct(
        F.col(correlation_col).cast("string").alias("correlation_id"),
        F.lit(source_table).alias("source_table"),
        F.col(event_col).cast("string").alias("source_event_id"),
        F.lit(module_id).alias("module_id"),
        F.lit(detector_name).alias("detector_name"),
        F.lit(lin_config_hash(cfg)).alias("config_hash"),
        F.lit(processed_at).alias("processed_at"),
        F.lit(pipeline_version).alias("pipeline_version"),
    )
    return df.withColumn("_lineage", lineage)


def lin_attach_latest(df: DataFrame, module_id: str, detector_name: str, cfg: dict, processed_at: str) -> DataFrame:
    """Lineage of an aggregated row: its latest event (last_event_id,
    last_timestamp, last_exchange)."""
    cid = lin_correlation_id("last_exchange", "symbol", iso_ms("last_timestamp"))
    return lin_attach(df.withColumn("correlation_id", cid), module_id, detector_name, cfg, processed_at, event_col="last_event_id")


def lin_attach_source(df: DataFrame, module_id: str, detector_name: str, cfg: dict, processed_at: str, source_table: str, event, place, ts) -> DataFrame:
    """Lineage of a row of another source than the raw trades: ``event`` names the source row, ``place``
    (two columns, as a chain and a wallet) and ``ts`` its correlation id."""
    cid = lin_correlation_id(*[F.coalesce(c.cast("string"), F.lit("")) for c in place], iso_ms(ts))
    d = df.withColumn("_event", event.cast("string")).withColumn("_cid", cid)
    return lin_attach(d, module_id, detector_name, cfg, processed_at, source_table=source_table, event_col="_event", correlation_col="_cid").drop("_event", "_cid")


def lin_merge_details(df: DataFrame, details_col: str = "details") -> DataFrame:
    """Nest ``_lineage`` inside the ``details`` struct and serialise last."""
    merged = F.col(details_col).withField("_lineage", F.col("_lineage"))
    return df.withColumn(details_col, F.to_json(merged)).drop("_lineage")


def lineage_rows(alerts: DataFrame, keep=()) -> DataFrame:
    """Alerts with their lineage as columns instead of JSON: the form the lookups read.
    ``keep`` names further alert columns. An alert without lineage has nulls."""
    schema = ", ".join(f"{f} string" for f in LINEAGE_FIELDS)
    d = alerts.withColumn("_l", F.from_json(F.get_json_object("details", "$._lineage"), schema))
    return d.select("alert_id", "alert_type", "module_id", "symbol", "exchange", "detected_at", *keep,
                    *[F.col(f"_l.{f}").alias("lineage_module_id" if f == "module_id" else f) for f in LINEAGE_FIELDS])


def write_lineage(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """The lineage table, written beside the alerts: partitioned by day (``dt``), and in each file
    sorted by correlation id, so that a lookup reads the days asked for and skips the row groups
    that can't hold the id. A day with many alerts is spread over several files."""
    rows = lineage_rows(alerts).withColumn("dt", F.date_format("detected_at", "yyyy-MM-dd"))
    rows.repartitionByRange("dt", "correlation_id").sortWithinPartitions("dt", "correlation_id").write.mode(mode).partitionBy("dt").parquet(path)


def _rows(alerts: DataFrame, since=None, until=None) -> DataFrame:
    """The lineage table, or alerts turned into it, within the days from ``since`` to ``until``."""
    rows = alerts if "correlation_id" in alerts.columns else lineage_rows(alerts)
    for bound, low in ((since, True), (until, False)):
        if bound is not None:
            at = bound if isinstance(bound, F.Column) else F.lit(bound).cast("timestamp")
            if "dt" in rows.columns:
                day = F.date_format(at, "yyyy-MM-dd")
                rows = rows.where(F.col("dt").cast("string") >= day if low else F.col("dt").cast("string") <= day)
            rows = rows.where(F.col("detected_at") >= at if low else F.col("detected_at") <= at)
    return rows


def _value(x) -> F.Column:
    return x if isinstance(x, F.Column) else F.lit(x)


def lin_by_correlation(alerts: DataFrame, cid, since=None, until=None) -> DataFrame:
    """All alerts carrying a correlation id, oldest first; ``alerts`` may be the lineage
    table, whose days and sorted files prune the read."""
    rows = _rows(alerts, since, until).where(F.col("correlation_id") == _value(cid))
    return rows.select("alert_id", "alert_type", "detected_at", "correlation_id", "lineage_module_id", "detector_name",
                       "config_hash").orderBy("detected_at", "alert_id")


def lin_by_config(alerts: DataFrame, config_hash: str, since=None, until=None) -> DataFrame:
    """Alert counts for one config hash by alert, module and time."""
    return (_rows(alerts, since, until).where(F.col("config_hash") == _value(config_hash))
            .groupBy("alert_id", "module_id", "detected_at").agg(F.count(F.lit(1)).alias("alert_count")))


def lin_trace_raw(alerts: DataFrame, trades: DataFrame, cid=None, since=None, until=None) -> DataFrame:
    """Alerts (or rows of the lineage table) with the raw trade behind each: the trade itself, or the
    one that closed the window. Event, symbol and correlation id must agree; the id holds the venue, which
    alerts over several venues don't name. The join is left to the planner and AQE."""
    a = _rows(alerts, since, until).where(F.col("source_table") == "raw_trades")
    if cid is not None:
        a = a.where(F.col("correlation_id") == _value(cid))
    a = a.select("alert_id", "alert_type", "detected_at", F.col("symbol").alias("_symbol"), "source_event_id", "correlation_id")
    t = trades.select("event_id", "exchange", "symbol", "price", "quantity", "timestamp",
                      lin_correlation_id("exchange", "symbol", iso_ms("timestamp")).alias("_cid"))
    t = t.toDF(*["t_" + c for c in t.columns])  # both sides may come from one frame
    j = a.join(t, (F.col("source_event_id") == F.col("t_event_id")) & (F.col("_symbol") == F.col("t_symbol")) & (F.col("correlation_id") == F.col("t__cid")))
    return j.select(*[F.col("t_" + c).alias(c) for c in ("exchange", "symbol", "event_id", "price", "quantity")],
                    "alert_id", "alert_type", "detected_at", "correlation_id")
