"""Registered queries: Structured Streaming jobs (SURVEY 2.11 streams,
2.1 src_trades_stream, 2.8 wallet_alpha_incremental).

Each query streams the whole input folder, a micro-batch per slice, with an availableNow trigger into
fresh sink and checkpoint folders under ``spark.checkpoint.dir``, waits for
the run to finish, and returns the sink read back. Append-mode windows are
emitted once the watermark passes their end, so the oracles drop windows
ending after max(event time) - watermark (FIXTURES 5)."""

from __future__ import annotations

import contextlib
import os
import time

from pyspark.sql import functions as F

from tradewatch.functions.columns import stable_round
from tradewatch.operators import normalize as N
from tradewatch.operators.alerts import ALERT_SCHEMA
from tradewatch.operators.quality import TRADE_JSON_SCHEMA
from tradewatch.operators.windows import stored
from tradewatch.plans.files import remove, signature
from tradewatch.plans.sinks import read_if_exists
from tradewatch.sources import adapters as A
from tradewatch.sources import trades as TR
from tradewatch.streaming import jobs as J
from tradewatch.streaming.wallet_state import wallet_alpha_batch
from tradewatch.suite import core, detect, identity
from tradewatch.suite.core import ALERT_BASE, TRADE_COLS, WHALE_ALERTS_SQL, alert_view
from tradewatch.suite.oracle import SQL as ORACLE
from tradewatch.suite.oracle import TRADES_E, alert_id, sround, with_
from tradewatch.suite.registry import PROCESSED_AT, query, sql
from tradewatch.suite.storage import fixture, fresh

VOL_WM, SPREAD_WM, FLOW_WM = "30 seconds", "15 seconds", "30 seconds"


SLICES = 4  # parts of the rows that arrive one after the other, each as a micro-batch
FILE_ROWS = 50_000  # a slice has a file for so many rows, one per core at most


def _files(spark, rows: int) -> int:
    return max(1, min(spark.sparkContext.defaultParallelism, rows // FILE_ROWS))


def _in_slices(spark, sf, name, table, ts):
    """A source folder whose files arrive in the order of ``ts``: the file source takes them by
    change time, so the slices are written one by one (rows without a time come first). The rows are made once, by
    all cores; slices have about the same number of rows and, as a micro-batch takes, the same number of files."""
    def build(path):
        df = stored(table().withColumn("_at", F.unix_micros(ts)), name)
        cuts = df.agg(F.percentile_approx("_at", [i / SLICES for i in range(1, SLICES)], 1000)).first()[0] or []
        part = sum([F.when(F.col("_at") > c, 1).otherwise(0) for c in cuts], F.lit(0))
        sizes = {r["part"]: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}  # SLICES at most
        files = _files(spark, min(sizes.get(i, 0) for i in range(SLICES)))
        remove(spark, path)  # of a writer that was cut short
        for i in range(SLICES):
            rows = df.where(part == i).drop("_at")
            rows = rows.repartition(files) if files > 1 else rows.coalesce(1)
            rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(i == SLICES - 1).lower()).mode("append").parquet(path)
            time.sleep(1.1)  # change times may have whole seconds only
    return fixture(spark, sf, name, build)


def _stream(spark, path, schema):
    """A micro-batch per slice."""
    files = sum(name.endswith(".parquet") for name, _, _ in signature(spark, path))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, files // SLICES)).parquet(path)


def trades_source(spark, sf):
    path = _in_slices(spark, sf, "trades_slices", lambda: A.trades_e(spark, sf), F.col("timestamp"))
    return _stream(spark, path, spark.read.parquet(path).schema)


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@contextlib.contextmanager
def state_partitions(spark):
    """Start test streams with one state partition per core: the count of
    stateful partitions is fixed when a query first starts (it is kept in
    the checkpoint) and AQE does not coalesce them, so a session default of
    200 would give 200 state stores for a few thousand windows. The session
    value is restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@query("src_trades_stream")
def q_src_trades_stream(spark, sf):
    path = fixture(spark, sf, "payloads_text", lambda where: N.norm_payload(A.trades_e(spark, sf)).select("payload").repartition(
        SLICES).write.mode("overwrite").text(where))
    p = TR.stream_trades(spark, "text", {"maxFilesPerTrigger": "1"}, TRADE_JSON_SCHEMA, path=path)
    out, ck = fresh(spark, "stream_trades"), fresh(spark, "ck")
    with state_partitions(spark):
        _run(J.start(p, out, ck))
    return spark.read.parquet(out).select(*TRADE_COLS, "ingestion_timestamp")


sql("src_trades_stream", with_(TRADES_E) + """
SELECT event_id, exchange, symbol, price, quantity, quote_volume, side, date_trunc('millisecond', "timestamp") AS "timestamp",
  date_trunc('millisecond', ingestion_timestamp) AS ingestion_timestamp FROM trades_e""")


@query("stream_whale")
def q_stream_whale(spark, sf):
    out, ck = fresh(spark, "stream_whale"), fresh(spark, "ck")
    with state_partitions(spark):
        _run(J.start(J.stream_whale(trades_source(spark, sf), core.CFG, PROCESSED_AT), out, ck))
    return alert_view(spark.read.parquet(out), core.WHALE_FIELDS)


sql("stream_whale", with_(TRADES_E, WHALE_ALERTS_SQL) + f"""
SELECT {ALERT_BASE}, d_quote_volume, d_price, d_quantity, d_side, d_correlation_id FROM whale_alerts""")

TAIL = "(SELECT max(\"timestamp\") FROM trades_e) - INTERVAL {wm}"


def _volume_run(spark, sf):
    base, ck = fresh(spark, "stream_volume"), fresh(spark, "ck")
    agg_path, out = os.path.join(base, "volume_aggregates"), os.path.join(base, "out")
    src = J.stream_volume_aggregates(trades_source(spark, sf), detect.VOL_W, VOL_WM)
    with state_partitions(spark):
        _run(J.start_batches(src, J.volume_batch(agg_path, out, detect.CFG, detect.VOL_LB, PROCESSED_AT), ck))
    return out


@query("stream_volume")
def q_stream_volume(spark, sf):
    scored = spark.read.parquet(os.path.join(_volume_run(spark, sf), "scored"))
    return scored.select("window_start", "symbol", "exchange", F.round("z_score", 6).alias("z_score"), "severity")


sql("stream_volume", with_(TRADES_E) + detect.VOL_SQL + f"""
SELECT window_start, symbol, exchange, round(z_score, 6) AS z_score, severity FROM vs
WHERE window_end <= {TAIL.format(wm="30 SECOND")}""")


@query("stream_volume_alerts")
def q_stream_volume_alerts(spark, sf):
    return _routed(spark, _volume_run(spark, sf))


sql("stream_volume_alerts", with_(TRADES_E) + detect.VOL_SQL + detect.VOL_ALERTS_SQL + f"""
SELECT alert_id, alert_type, symbol, severity, detected_at, 'MOD-001' AS lineage_module, true AS in_hot FROM vol_alerts
WHERE detected_at <= {TAIL.format(wm="30 SECOND")}""")


def _spread_run(spark, sf):
    base, ck = fresh(spark, "stream_spread"), fresh(spark, "ck")
    src = J.stream_vwap(trades_source(spark, sf), detect.SPREAD_W, SPREAD_WM)
    with state_partitions(spark):
        _run(J.start_batches(src, J.spread_batch(base, detect.CFG, PROCESSED_AT), ck))
    return base


def _alerts(spark, path):
    """An alert store; one that no alert has reached has no file to take a schema from."""
    found = read_if_exists(spark, path)
    return spark.createDataFrame([], ALERT_SCHEMA) if found is None else found


def _routed(spark, base):
    """What reached the cold store, and whether the hot one and the lineage agree."""
    cold, hot = (_alerts(spark, os.path.join(base, k)) for k in ("cold", "hot"))
    module = F.get_json_object("details", "$._lineage.module_id")
    return cold.join(hot.select("alert_id", F.lit(True).alias("in_hot")), "alert_id", "left").select(
        "alert_id", "alert_type", "symbol", "severity", "detected_at", module.alias("lineage_module"), F.coalesce("in_hot", F.lit(False)).alias("in_hot"))


@query("stream_spread")
def q_stream_spread(spark, sf):
    s = spark.read.parquet(os.path.join(_spread_run(spark, sf), "rows"))
    return s.select("window_start", "window_end", "symbol", "exchange_a", "exchange_b",
                    F.round("spread_pct", 6).alias("spread_pct"))


sql("stream_spread", with_(TRADES_E) + detect.SPREAD_SQL + f"""
SELECT window_start, window_end, symbol, exchange_a, exchange_b, round(spread_pct, 6) AS spread_pct FROM sp
WHERE window_end <= {TAIL.format(wm="15 SECOND")}""")


@query("stream_spread_alerts")
def q_stream_spread_alerts(spark, sf):
    return _routed(spark, _spread_run(spark, sf))


sql("stream_spread_alerts", with_(TRADES_E) + detect.SPREAD_SQL + detect.SPREAD_ALERTS_SQL + f"""
SELECT alert_id, alert_type, symbol, severity, detected_at, 'MOD-003' AS lineage_module, true AS in_hot FROM spread_alerts
WHERE detected_at <= {TAIL.format(wm="15 SECOND")}""")


def _flow_run(spark, sf):
    base, ck = fresh(spark, "stream_flow"), fresh(spark, "ck")
    flows = J.stream_flow(trades_source(spark, sf), identity.CFG, identity.FLOW_W, FLOW_WM)
    with state_partitions(spark):
        _run(J.start_batches(flows, J.flow_batch(base, identity.CFG, PROCESSED_AT), ck))
    return base


@query("stream_flow")
def q_stream_flow(spark, sf):
    f = spark.read.parquet(os.path.join(_flow_run(spark, sf), "rows"))
    return f.select("window_start", "window_end", "symbol", "buy_volume", "sell_volume",
                    stable_round("flow_ratio", 6).alias("flow_ratio"), "whale_count")


@query("stream_flow_alerts")
def q_stream_flow_alerts(spark, sf):
    return _routed(spark, _flow_run(spark, sf))


sql("stream_flow_alerts", with_(TRADES_E) + identity.FLOW_SQL + f"""
SELECT {alert_id('alert_type', 'NULL', 'symbol', 'epoch_us(window_start) // 1000000')} AS alert_id, alert_type, symbol, severity,
  window_end AS detected_at, 'MOD-006' AS lineage_module, true AS in_hot FROM fla WHERE window_end <= {TAIL.format(wm="30 SECOND")}""")


sql("stream_flow", with_(TRADES_E) + identity.FLOW_SQL + f"""
SELECT window_start, window_end, symbol, buy_volume, sell_volume, {sround('flow_ratio', 6)} AS flow_ratio, whale_count
FROM fl WHERE window_end <= {TAIL.format(wm="30 SECOND")}""")


def _dq_run(spark, sf, slices):
    """The dirty feed in micro-batches by event time, or as one."""
    if slices:
        at = F.try_to_timestamp(F.regexp_replace(F.get_json_object("value", "$.timestamp"), "Z$", ""))
        path = _in_slices(spark, sf, "dirty_slices", lambda: A.raw_dirty(spark, sf), at)
    else:
        path = fixture(spark, sf, "raw_dirty", lambda where: A.raw_dirty(spark, sf).write.mode("overwrite").parquet(where))
    schema = "key string, value string"
    src = J.observe_quality(_stream(spark, path, schema) if slices else spark.readStream.schema(schema).parquet(path))
    base, ck = fresh(spark, "stream_dq"), fresh(spark, "ck")
    paths = {k: os.path.join(base, k) for k in ("valid", "dlq", "metrics")}
    with state_partitions(spark):
        _run(J.start_batches(src, J.quality_batch(paths["valid"], paths["dlq"], paths["metrics"], core.DQ_CFG,
                                                  core.AS_OF_DAY), ck))
    return paths


@query("stream_dq")
def q_stream_dq(spark, sf):
    v = spark.read.parquet(_dq_run(spark, sf, True)["valid"])
    return v.select("key", "event_id", "exchange", "symbol", "price", "timestamp")


sql("stream_dq", ORACLE["dq_dedup"])


@query("metrics_delivery")
def q_metrics_delivery(spark, sf):
    m = spark.read.parquet(_dq_run(spark, sf, False)["metrics"])
    return m.select("batch_id", "processed", "records_sent", "valid_sent", "dlq_sent", "dropped_duplicates",
                    "send_failures")


sql("metrics_delivery", with_(TRADES_E, core.DIRTY) + """
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS processed,
  count(*) FILTER (WHERE NOT is_duplicate) AS records_sent,
  count(*) FILTER (WHERE reason IS NULL AND NOT is_duplicate) AS valid_sent,
  count(*) FILTER (WHERE reason IS NOT NULL) AS dlq_sent, count(*) FILTER (WHERE is_duplicate) AS dropped_duplicates,
  CAST(0 AS BIGINT) AS send_failures FROM flagged""")


@query("wallet_alpha_incremental")
def q_wallet_alpha_incremental(spark, sf):
    # slices by trade, not by time: each batch brings late rows of all days
    def build(where):
        files = _files(spark, A.trades_l(spark, sf).count() // SLICES)
        A.wallet_trades(spark, sf).repartition(SLICES * files, "event_id").write.mode("overwrite").parquet(where)
    path = fixture(spark, sf, "wallet_slices", build)
    src = _stream(spark, path, spark.read.parquet(path).schema)
    base, ck = fresh(spark, "wallet_alpha"), fresh(spark, "ck")
    fn = wallet_alpha_batch(*[os.path.join(base, k) for k in ("trades", "segments", "scores")], identity.DAYS, identity.MIN_TRADES)
    _run(J.start_batches(src, fn, ck))
    r = spark.read.parquet(os.path.join(base, "scores"))
    last = r.where(F.col("batch_id") == r.agg(F.max("batch_id")).scalar())
    return last.select("wallet", "blockchain", "trade_count", stable_round("alpha", 6).alias("alpha"))


# with a horizon longer than the data the streamed score equals the batch score
sql("wallet_alpha_incremental", ORACLE["wallet_alpha"])
