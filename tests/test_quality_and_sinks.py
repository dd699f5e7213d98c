"""Quality scenarios (FIXTURES 3), invariants, sink idempotence, streaming
equals batch."""

import json
import os
import uuid

from pyspark.sql import functions as F

from tradewatch.config import make_config
from tradewatch.operators import quality as Q
from tradewatch.operators.whale import whale_alerts, whale_detect
from tradewatch.plans import sinks as SK
from tradewatch.session import scratch_path
from tradewatch.sources import adapters as A
from tradewatch.streaming import jobs as J

from .conftest import SF_SMALL


def _event(**kw):
    base = {"event_id": "1", "exchange": "binance", "symbol": "BTC-USDT", "price": 100.0, "quantity": 2.0,
            "quote_volume": 200.0, "side": "buy", "timestamp": "2024-01-01T00:00:00.000Z",
            "ingestion_timestamp": "2024-01-01T00:00:01.000Z"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def test_quality_scenarios(spark):
    rows = [
        ("ok", _event(event_id="1")),
        ("null_price", _event(event_id="2", price=None)),
        ("neg_qty", _event(event_id="3", quantity=-1.0)),
        ("bad_symbol", _event(event_id="4", symbol="DOGE-XYZ")),
        ("bad_exchange", _event(event_id="5", exchange="kraken")),
        ("bad_side", _event(event_id="6", side="hold")),
        ("broken", '{"event_id": "7", "exch'),
        ("late", _event(event_id="8", ingestion_timestamp="2024-01-01T00:10:00.000Z")),
        ("dup_a", _event(event_id="9")),
        ("dup_b", _event(event_id="9", timestamp="2024-01-01T00:00:10.000Z",
                         ingestion_timestamp="2024-01-01T00:00:11.000Z")),
        ("qv_off", _event(event_id="10", quote_volume=202.0)),
    ]
    df = spark.createDataFrame(rows, "key string, value string")
    valid, invalid, metrics = Q.dq_validate(df, make_config(), processing_date="2024-01-02")
    reasons = {r.key: r.reason for r in invalid.collect()}
    assert reasons == {"null_price": "incomplete", "neg_qty": "invalid", "bad_symbol": "invalid",
                       "bad_exchange": "invalid", "bad_side": "invalid", "broken": "malformed"}
    v = {r.event_id: r for r in valid.collect()}
    assert set(v) == {"1", "8", "9", "10"}
    assert v["8"].is_late and not v["1"].is_late
    assert v["10"].qv_warn and not v["1"].qv_warn
    m = metrics.first()
    assert (m.processed, m.passed, m.failed, m.duplicate, m.late) == (11, 4, 6, 1, 1)
    assert m.passed + m.failed + m.duplicate == m.processed  # invariant


def test_dirty_fixture_rule_counts(spark):
    flagged = Q.dq_flag(A.raw_dirty(spark, SF_SMALL), make_config())
    m = Q.dq_metrics(flagged).first()
    assert m.passed + m.failed + m.duplicate == m.processed
    assert 0 <= m.quality_score_pct <= 100


def test_upsert_is_idempotent(spark):
    path = scratch_path(spark, "tests", uuid.uuid4().hex)
    alerts = whale_alerts(whale_detect(A.trades_e(spark, SF_SMALL), make_config()))
    SK.sink_upsert(alerts, path)
    n1 = spark.read.parquet(path).count()
    SK.sink_upsert(alerts, path)
    SK.sink_upsert(alerts.limit(5), path)
    assert spark.read.parquet(path).count() == n1 == alerts.count()


def test_flow_buy_plus_sell_is_whale_volume(spark):
    from tradewatch.operators.flow import flow_aggregate
    whales = whale_detect(A.trades_e(spark, SF_SMALL), make_config())
    total = whales.agg(F.sum(F.col("quote_volume").cast("decimal(28,8)")).cast("double")).first()[0]
    f = flow_aggregate(whales, "6 hours").agg(F.sum("buy_volume") + F.sum("sell_volume")).first()[0]
    assert abs(total - f) < 1e-3


def test_stream_whale_equals_batch(spark):
    src_path = scratch_path(spark, "tests", uuid.uuid4().hex)
    A.trades_e(spark, SF_SMALL).write.parquet(src_path)
    stream = spark.readStream.schema(spark.read.parquet(src_path).schema).parquet(src_path)
    out, ck = scratch_path(spark, "tests", uuid.uuid4().hex), scratch_path(spark, "tests", uuid.uuid4().hex)
    q = J.start(J.stream_whale(stream, make_config(), "2024-02-01T00:00:00.000Z"), out, ck)
    q.awaitTermination()
    got = {r.alert_id for r in spark.read.parquet(out).collect()}
    want = {r.alert_id for r in whale_alerts(whale_detect(A.trades_e(spark, SF_SMALL), make_config())).collect()}
    assert got == want and len(got) > 0
    assert os.path.isdir(out)
