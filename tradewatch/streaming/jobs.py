"""Structured Streaming jobs.

Each job takes a streaming DataFrame of unified trades (or raw payloads) and
writes to folders under a base path. Windowed aggregates run in append mode
behind a watermark. Steps that need history (the volume baseline) or several
outputs (quality split) run in ``foreachBatch`` on the closed windows of the
micro-batch; every batch writes to ``.../batch_id=<epoch>`` with overwrite,
so a replayed epoch after a failure rewrites the same files (idempotent)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewatch.operators import flow as FL
from tradewatch.operators import lineage as L
from tradewatch.operators import quality as Q
from tradewatch.operators import spread as S
from tradewatch.operators import volume as V
from tradewatch.operators import whale as W
from tradewatch.plans.files import exists, remove, signature
from tradewatch.plans.sinks import read_if_exists, route_alerts


def _batch_dir(base: str, epoch: int) -> str:
    return os.path.join(base, f"batch_id={epoch}")


def start(df: DataFrame, path: str, checkpoint: str, available_now: bool = True, processing_time: str | None = None,
          mode: str = "append", fmt: str = "parquet", partition_by=()) -> StreamingQuery:
    """File sink (exactly once through its commit log); ``partition_by`` gives
    the partitioned streaming form of sink_partitioned."""
    w = df.writeStream.format(fmt).outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def start_batches(df: DataFrame, fn, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


# ---- stateless ------------------------------------------------------------------------------

def stream_whale(src: DataFrame, cfg: dict, processed_at: str | None = None) -> DataFrame:
    """Whale detector as a map-only stream (no state, no watermark)."""
    w = L.with_correlation_id(W.whale_detect(src, cfg))
    w = L.lin_attach(w, "MOD-002", "whale-detector", cfg["whale_detector"], processed_at or "stream")
    if processed_at is None:
        w = w.withColumn("_lineage", F.col("_lineage").withField("processed_at", F.date_format(
            F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))
    return W.whale_alerts(w, cfg)


def stream_dedup(src: DataFrame, seconds: int = 3600) -> DataFrame:
    """Drop repeats of (exchange, symbol, event_id) within the watermark."""
    return src.withWatermark("timestamp", f"{seconds} seconds").dropDuplicatesWithinWatermark(list(Q.KEY))


# ---- windowed, append ---------------------------------------------------------------------------

def stream_flow(src: DataFrame, cfg: dict, width: str, watermark: str) -> DataFrame:
    """Whale filter, then buy/sell flow per tumbling window; the watermark
    follows all trades, not only whales."""
    whales = W.whale_detect(src.withWatermark("timestamp", watermark), cfg)
    return FL.flow_aggregate(whales, width)


def stream_vwap(src: DataFrame, width: str, watermark: str) -> DataFrame:
    return S.vwap(src.withWatermark("timestamp", watermark), width)


def detector_batch(rows_path: str, rows_of, alerts_of, hot_path: str, cold_path: str):
    """foreachBatch body of a windowed detector: the rows of the batch's closed windows
    are written as ``batch_id=<epoch>``, and their alerts are routed to the hot and cold
    stores, which a replayed batch leaves as they are."""
    def fn(batch: DataFrame, epoch: int) -> None:
        rows = rows_of(batch).persist()
        try:
            rows.write.mode("overwrite").parquet(_batch_dir(rows_path, epoch))
            route_alerts(alerts_of(rows), hot_path, cold_path, epoch)
        finally:
            rows.unpersist()
    return fn


def spread_batch(base: str, cfg: dict, processed_at: str):
    """Spreads and their alerts; all venues of a window close in the same
    batch, so the spread of the batch's windows is complete."""
    c = cfg["spread_calculator"]

    def alerts(rows: DataFrame) -> DataFrame:
        s = L.lin_attach_latest(rows, "MOD-003", "spread-calculator", c, processed_at)
        return S.spread_alerts(s, c["spread_threshold_pct"], c["spread_high_pct"])
    return detector_batch(os.path.join(base, "rows"), S.spread, alerts, os.path.join(base, "hot"), os.path.join(base, "cold"))


def flow_batch(base: str, cfg: dict, processed_at: str):
    """Flows of closed windows and their alerts."""
    c = cfg["flow"]

    def alerts(rows: DataFrame) -> DataFrame:
        f = L.lin_attach_latest(rows, "MOD-006", "flow-direction", c, processed_at)
        return FL.flow_alerts(f, c["accumulation"], c["distribution"], c["strong_accumulation"], c["strong_distribution"])
    return detector_batch(os.path.join(base, "rows"), lambda b: b, alerts, os.path.join(base, "hot"), os.path.join(base, "cold"))


def stream_volume_aggregates(src: DataFrame, width: str, watermark: str) -> DataFrame:
    return V.vol_aggregate(src.withWatermark("timestamp", watermark), width)


def volume_batch(agg_path: str, out_path: str, cfg: dict, lookback: int, processed_at: str | None = None):
    """foreachBatch body for MOD-001: append the closed windows to the
    aggregates table, then score them against the earlier windows read back
    from that table within ``lookback`` (the table is the state). The alerts are
    routed to the hot and cold stores.

    The table is partitioned by (date, batch_id): a replayed epoch overwrites
    only its own partitions, and the read-back lists only the folders of the
    days the lookback touches (a path glob), so the cost of a micro-batch does
    not grow with the number of batches the stream has run. The micro-batch
    is persisted because it is used three times."""
    va = cfg["volume_anomaly"]
    keys = ["symbol", "exchange", "window_start"]

    def fn(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        b = batch.persist()
        try:
            span = b.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).first()
            if span["lo"] is None:
                return
            (b.withColumn("date", F.to_date("window_start")).withColumn("batch_id", F.lit(epoch))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("date", "batch_id").parquet(agg_path))
            first = (span["lo"] - dt.timedelta(seconds=lookback)).date()
            days = [first + dt.timedelta(days=i) for i in range((span["hi"].date() - first).days + 1)]
            glob = os.path.join(agg_path, "date={" + ",".join(d.isoformat() for d in days) + "}")
            hist = spark.read.option("basePath", agg_path).parquet(glob).drop("date", "batch_id")
            hist = hist.where(F.col("window_start") >= F.lit(span["lo"] - dt.timedelta(seconds=lookback)))
            base = V.vol_baseline(hist, lookback, va["min_windows"])
            scored = V.vol_zscore(base, va["z_score_medium"], va["z_score_high"]).join(
                b.select(*keys), keys, "left_semi")
            scored.write.mode("overwrite").parquet(_batch_dir(os.path.join(out_path, "scored"), epoch))
            done = spark.read.parquet(_batch_dir(os.path.join(out_path, "scored"), epoch))
            s = L.lin_attach(done, "MOD-001", "volume-anomaly", va, processed_at or "stream",
                             event_col="last_event_id")
            route_alerts(V.vol_spike_alerts(s, cfg), os.path.join(out_path, "hot"), os.path.join(out_path, "cold"), epoch)
        finally:
            b.unpersist()
    return fn


# ---- quality ---------------------------------------------------------------------------------------

def observe_quality(raw: DataFrame) -> DataFrame:
    """Per-batch counters delivered in the query progress (observedMetrics)."""
    return raw.observe("dq_input", F.count(F.lit(1)).alias("records"),
                       F.count(F.when(F.col("value").isNull(), 1)).alias("null_payloads"))


KEY_FILES = 16  # files of a day's keys before they are compacted
KEYS_SCHEMA = "key string, timestamp timestamp, batch_id long, day string"


def _key() -> F.Column:
    """Names an event: a digest, as nulls in one part must not run into another."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in Q.KEY]), {"ignoreNullFields": "false"}), 256)


def _spans(flagged: DataFrame, seconds: int) -> list[tuple[str, dt.datetime, dt.datetime]]:
    """(day, from, to) of what could make a row of the batch a duplicate. Spans are those of the days
    present, so a single very old row adds its own day and no more."""
    ok = flagged.where(F.col("reason").isNull() & F.col("timestamp").isNotNull())
    wide, out = dt.timedelta(seconds=seconds), []
    for r in ok.groupBy(F.to_date("timestamp").alias("d")).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect():  # of one batch
        lo, hi = r["lo"] - wide, r["hi"] + wide
        out += [((lo.date() + dt.timedelta(days=i)).isoformat(), lo, hi) for i in range((hi.date() - lo.date()).days + 1)]
    return out


def _day_path(keys_path: str, day: str) -> str:
    return os.path.join(keys_path, f"day={day}")


def _keys_of(spark, keys_path: str, days) -> DataFrame | None:
    """The stored keys of some days. Only their folders are listed, however long the stream has run."""
    paths = [p for p in (_day_path(keys_path, d) for d in sorted(set(days))) if exists(spark, p)]
    return spark.read.option("basePath", keys_path).schema(KEYS_SCHEMA).parquet(*paths) if paths else None


def _seen_before(flagged: DataFrame, keys_path: str, epoch: int, seconds: int) -> DataFrame:
    """Mark rows whose event an earlier batch kept within ``seconds``. Keys of this and later
    batches are left out, so a replay sees what the first run saw; the time filter reaches the
    files, whose statistics skip what lies elsewhere in the day."""
    spans = _spans(flagged, seconds)
    prior = _keys_of(flagged.sparkSession, keys_path, [d for d, _, _ in spans])
    if prior is None:
        return flagged
    near_day = F.lit(False)
    for day, lo, hi in spans:
        near_day = near_day | ((F.col("day") == day) & F.col("timestamp").between(F.lit(lo), F.lit(hi)))
    prior = prior.where((F.col("batch_id") < epoch) & near_day).select(F.col("key").alias("_key"), F.col("timestamp").alias("_seen"))
    near = F.abs(F.unix_micros("timestamp") - F.unix_micros("_seen")) <= F.lit(seconds * 1_000_000)
    keyed = flagged.withColumn("_k", F.when(F.col("reason").isNull(), _key()))
    hit = keyed.join(prior, (F.col("_k") == F.col("_key")) & near, "left_semi").withColumn("is_duplicate", F.lit(True))
    miss = keyed.join(prior, (F.col("_k") == F.col("_key")) & near, "left_anti")
    return hit.unionByName(miss).drop("_k")


def _remember(valid: DataFrame, keys_path: str, epoch: int) -> None:
    """Append the kept events' keys by day, sorted by time. A day that has got many files is compacted:
    the new files are complete before the old ones go."""
    rows = valid.select(_key().alias("key"), "timestamp", F.lit(epoch).cast("long").alias("batch_id"),
                        F.date_format("timestamp", "yyyy-MM-dd").alias("day"))
    rows.repartitionByRange("day", "timestamp").sortWithinPartitions("day", "timestamp").write.mode("append").partitionBy("day").parquet(keys_path)
    spark = valid.sparkSession
    for day in [r[0] for r in rows.select("day").distinct().collect()]:  # of one batch
        path = _day_path(keys_path, day)
        old = [name for name, _, _ in signature(spark, path) if name.endswith(".parquet")]
        if len(old) > KEY_FILES:
            held = _keys_of(spark, keys_path, [day]).distinct()
            held.repartitionByRange("timestamp").sortWithinPartitions("timestamp").write.mode("append").partitionBy("day").parquet(keys_path)
            remove(spark, *[os.path.join(path, name) for name in old])


def _write(df: DataFrame, path: str, by=()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def _delivered(df: DataFrame, path: str, by=()) -> tuple[int, Exception | None]:
    """Write a batch's folder and read back how many rows it holds; a failed write is told, not raised."""
    error = None
    try:
        _write(df, path, by)
    except Exception as e:  # noqa: BLE001  raised by the caller, once it is accounted for
        error = e
    found = read_if_exists(df.sparkSession, path)
    return 0 if found is None else found.count(), error


def quality_batch(valid_path: str, dlq_path: str, metrics_path: str, cfg: dict, processing_date: str | None = None,
                  keys_path: str | None = None):
    """foreachBatch body: validate, write valid rows and dead letters, and
    one delivery-metrics row per batch. The flagged batch is persisted so the
    writes share one computation. Duplicates are looked for in the batch
    and in the keys that earlier batches kept (``keys_path``, by day).

    The metrics compare the rows handed over with those found in the batch's folders; what
    is missing counts as ``send_failures``. After a failed write the row is written, then the batch fails, and
    its retry replaces the row."""
    keys = keys_path or valid_path.rstrip("/") + "_keys"

    def fn(batch: DataFrame, epoch: int) -> None:
        within = Q.dq_flag(batch, cfg).persist()
        flagged = _seen_before(within, keys, epoch, cfg["quality"]["dedup_seconds"]).persist()
        try:
            valid = flagged.where(F.col("reason").isNull() & ~F.col("is_duplicate")).drop(
                "failed_rules", "reason", "is_duplicate")
            day = F.current_date() if processing_date is None else F.lit(processing_date).cast("date")
            invalid = flagged.where(F.col("reason").isNotNull()).withColumn(
                "dt", F.date_format(F.coalesce(F.to_date("timestamp"), day), "yyyy-MM-dd")).drop("is_duplicate")
            m = Q.dq_metrics(flagged)
            n_valid, failed = _delivered(valid, _batch_dir(valid_path, epoch))
            n_dlq, failed_dlq = _delivered(invalid, _batch_dir(dlq_path, epoch), ("reason", "dt"))
            sent, dead = F.lit(n_valid).cast("long"), F.lit(n_dlq).cast("long")
            m.select(F.lit(epoch).cast("long").alias("batch_id"), "processed", (sent + dead).alias("records_sent"),
                     sent.alias("valid_sent"), dead.alias("dlq_sent"), F.col("duplicate").alias("dropped_duplicates"),
                     (F.col("passed") + F.col("failed") - sent - dead).alias("send_failures")
                     ).write.mode("overwrite").parquet(_batch_dir(metrics_path, epoch))
            if failed or failed_dlq:
                raise failed or failed_dlq
            _remember(valid, keys, epoch)
        finally:
            flagged.unpersist()
            within.unpersist()
    return fn
