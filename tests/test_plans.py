"""Physical-plan properties that matter at scale."""

import contextlib
import io

import __spark_entry__ as E
from tradewatch.operators import windows as WH
from pyspark.sql import functions as F

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_raw_trades_read_prunes_partitions_and_pushes_time(spark):
    p = plan(E.queries()["src_trades_batch"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(date" in p and "symbol" in p.split("PartitionFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(timestamp" in p


def test_whale_path_has_no_shuffle_beyond_input_spread(spark):
    p = plan(E.queries()["whale_filter"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") <= 1  # only the under-split input spread
    assert "PushedFilters" in p and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p  # no Python UDF


def test_alerts_query_is_top_k(spark):
    p = plan(E.queries()["alerts_query"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_percent_rank_has_no_single_partition_window(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 97).cast("double").alias("v"))
    p = plan(WH.distributed_percent_rank(df, ["g"], "v"))
    assert "SinglePartition" not in p
    assert "rangepartitioning" in p


def test_no_python_udf_in_batch_queries(spark):
    q = E.queries()
    for name in ["dq_validate", "vol_spike_alerts", "consensus_alerts", "wallet_alpha", "dex_price_impact",
                 "bt_report", "pred_score", "metrics_symbol"]:
        p = plan(q[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_lookups_force_no_broadcast(spark):
    from tradewatch.operators.labels import label_enrich
    from tradewatch.operators.onchain import onchain_known_wallet
    trades = spark.createDataFrame([(1, 2, 3)], "wallet long, from_wallet long, to_wallet long")
    labels = spark.createDataFrame([(2, "a", "b"), (2, "a", "b")], "wallet long, label string, entity_type string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(label_enrich(trades, labels))
        assert "BroadcastHashJoin" not in plan(onchain_known_wallet(trades, labels))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert onchain_known_wallet(trades, labels).count() == 1
