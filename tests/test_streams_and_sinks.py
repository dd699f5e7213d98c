"""Streams over several micro-batches, replayed batches, lineage of every
module, and the statistics and pointers of stored tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

import tradewatch.suite.serve as serve
from tradewatch.operators import lineage as L
from tradewatch.operators.alerts import alert_union
from tradewatch.plans import lake as LK
from tradewatch.plans import sinks as SK
from tradewatch.plans.modules import run_modules
from tradewatch.sources import adapters as A
from tradewatch.streaming import jobs as J
from tradewatch.suite import core

from .conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _payload(i, seconds):
    at = (T0 + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return json.dumps({"event_id": str(i), "exchange": "binance", "symbol": "BTC-USDT", "price": 1.0, "quantity": 1.0, "quote_volume": 1.0,
                       "side": "buy", "timestamp": at, "ingestion_timestamp": at})


def test_duplicates_are_found_across_micro_batches(spark, tmp_path):
    paths = [str(tmp_path / k) for k in ("valid", "dlq", "metrics")]
    fn = J.quality_batch(*paths, core.DQ_CFG, "2024-01-01")
    batches = [[(1, 0), (2, 0), (2, 5)], [(1, 10), (3, 0)], [(1, 2 * 3600), (2, 3000), (9, -1)]]
    frames = [spark.createDataFrame([(str(i), _payload(i, s) if i != 9 else "{") for i, s in b], "key string, value string") for b in batches]
    for epoch in (0, 1, 2, 1):  # batch 1 is replayed
        fn(frames[epoch], epoch)
    valid = spark.read.parquet(paths[0])
    got = sorted((r.event_id, int((r.timestamp - T0).total_seconds()), r.batch_id) for r in valid.collect())
    assert got == [("1", 0, 0), ("1", 7200, 2), ("2", 0, 0), ("3", 0, 1)]
    m = {r.batch_id: (r.processed, r.valid_sent, r.dlq_sent, r.dropped_duplicates)
         for r in spark.read.parquet(paths[2]).select("batch_id", "processed", "valid_sent", "dlq_sent", "dropped_duplicates").collect()}
    assert m == {0: (3, 2, 0, 1), 1: (2, 1, 0, 1), 2: (3, 1, 1, 1)}


def test_replayed_batch_changes_no_store(spark, tmp_path):
    alerts = serve.small_alerts(spark, SF_SMALL)
    hot, cold = str(tmp_path / "hot"), str(tmp_path / "cold")
    for _ in range(2):
        SK.route_alerts(alerts, hot, cold, batch_id=7)
    n = alerts.count()
    assert spark.read.parquet(hot).count() == n == spark.read.parquet(cold).count()


def test_upsert_reads_only_the_partitions_it_touches(spark, tmp_path, monkeypatch):
    alerts = serve.small_alerts(spark, SF_SMALL)
    path = str(tmp_path / "store")
    SK.sink_upsert(alerts, path)
    seen = []
    real = SK.read_if_exists

    def spy(session, where, fmt="parquet"):
        df = real(session, where, fmt)
        seen.append(df)
        return df
    monkeypatch.setattr(SK, "read_if_exists", spy)
    one = alerts.orderBy("detected_at").limit(1)
    plans = []
    join = type(alerts).join

    def watched(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if how == "left_anti":
            plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(type(alerts), "join", watched)
    SK.sink_upsert(one, path)
    assert len(seen) == 1 and spark.read.parquet(path).count() == alerts.count()
    assert plans and "PartitionFilters: [" in plans[0] and "cast(dt" in plans[0].split("PartitionFilters: [")[1].split("]")[0]


def test_every_module_attaches_lineage(spark):
    out = run_modules(A.trades_e(spark, SF_SMALL), serve.RUN_CFG, ("MOD-007", "MOD-003"), "2024-02-01T00:00:00.000Z")
    a = alert_union(*out.values())
    fields = F.json_object_keys(F.get_json_object("details", "$._lineage"))
    rows = a.groupBy("module_id").agg(F.min(F.size(fields)).alias("least"), F.count("*").alias("n")).collect()
    assert {r.module_id for r in rows} == {"MOD-001", "MOD-002", "MOD-003", "MOD-006", "MOD-007"}
    assert all(r.least == len(L.LINEAGE_FIELDS) for r in rows)


def test_pointer_outlives_the_view(spark, tmp_path):
    pointers, data = str(tmp_path / "pointers"), str(tmp_path / "data")
    spark.range(5).write.parquet(data)
    diff = spark.createDataFrame([("a", "same")] * 9 + [("b", "new")], "alert_id string, status string")
    assert LK.current_table(spark, pointers, "t") is None
    assert not LK.swap_if_valid(spark, pointers, "t", data, diff, 0.05).first().passed
    assert LK.current_table(spark, pointers, "t") is None
    assert LK.swap_if_valid(spark, pointers, "t", data, diff, 0.1).first().passed
    assert LK.current_table(spark, pointers, "t").count() == 5


def test_wallet_scores_on_shuffled_batches_equal_the_batch_operator(spark, tmp_path):
    """Late rows, a replayed batch, a wallet that falls silent, a 30-day horizon."""
    import random

    from tradewatch.operators.wallet import wallet_scores
    from tradewatch.streaming.wallet_state import wallet_alpha_batch
    r = random.Random(4)
    schema = "wallet long, blockchain string, ts timestamp, event_id string, ret double"
    rows = [(w, "solana", T0 + dt.timedelta(hours=r.randrange(60 * 24)), f"{w}-{i}", round(r.uniform(-1, 1), 3)) for w in range(4) for i in range(60)]
    rows += [(9, "solana", T0 + dt.timedelta(hours=i), f"9-{i}", 0.5 - i % 2) for i in range(20)]  # silent later
    r.shuffle(rows)
    parts = [rows[i::5] for i in range(5)]
    paths = [str(tmp_path / k) for k in ("trades", "segments", "scores")]
    fn = wallet_alpha_batch(*paths, days=30, min_trades=5)
    for epoch in (0, 1, 2, 1, 3, 4):
        fn(spark.createDataFrame(parts[epoch], schema), epoch)
    got = {x.wallet: (x.trade_count, x.max_drawdown, x.alpha) for x in spark.read.parquet(paths[2]).where("batch_id = 4").collect()}
    want = {x.wallet: (x.trade_count, x.max_drawdown, x.alpha)
            for x in wallet_scores(spark.createDataFrame(rows, schema), None, 30, 5).collect()}
    assert got == want and set(got) == {0, 1, 2, 3}


def test_wallet_summaries_of_a_month_are_written_by_many_tasks(spark, tmp_path):
    from tradewatch.streaming.wallet_state import wallet_alpha_batch
    schema = "wallet long, blockchain string, ts timestamp, event_id string, ret double"
    rows = [(w, "solana", T0 + dt.timedelta(minutes=w), f"{w}", 0.1) for w in range(40)]
    paths = [str(tmp_path / k) for k in ("trades", "segments", "scores")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wallet_alpha_batch(*paths)(spark.createDataFrame(rows, schema), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = list((tmp_path / "segments").glob("month=*/*.parquet"))
    assert len({f.parent for f in written}) == 1 and len(written) > 1


def test_wallet_state_is_bounded_by_batch_and_horizon(spark, tmp_path):
    """Many batches: a batch builds only its own pairs, files and days stay bounded, scores stay exact."""
    from tradewatch.operators.wallet import wallet_scores
    from tradewatch.streaming.wallet_state import latest_segments, wallet_alpha_batch
    schema = "wallet long, blockchain string, ts timestamp, event_id string, ret double"
    paths = [str(tmp_path / k) for k in ("trades", "segments", "scores")]
    fn, everything, files = wallet_alpha_batch(*paths, days=2, min_trades=1, compact_after=3), [], []
    for epoch in range(16):
        at = T0 + dt.timedelta(hours=6 * epoch - 24)  # from December on
        rows = [(w, "solana", at + dt.timedelta(minutes=w), f"{epoch}-{w}", ((epoch * 7 + w) % 5 - 2) / 10) for w in ([0, 1, 2] if epoch % 2 else [0, 3])]
        if epoch == 9:
            rows.append((5, "solana", at - dt.timedelta(days=1), "late", 0.3))
        everything += rows
        df = spark.createDataFrame(rows, schema)
        for _ in range(2 if epoch == 6 else 1):  # one batch is replayed
            fn(df, epoch)
        files.append(len(list((tmp_path / "segments").glob("month=*/*.parquet"))))
        made = spark.read.parquet(paths[1]).where(f"batch_id = {epoch}")
        days = {(r.wallet, f"{r.ts:%Y-%m-%d}") for r in df.collect()}
        if files[-1] >= files[-2 if epoch else -1]:  # not compacted by this batch
            assert made.select("wallet", "_tb").distinct().count() == len(days)
    assert max(files[7:]) <= 3 * 8 and max(files) < 14 * 3
    assert {p.name for p in (tmp_path / "trades").glob("month=*")} == {"month=2024-01"}
    latest = latest_segments(spark.read.parquet(paths[1]))
    assert latest.groupBy("wallet", "_tb").count().where("count > 1").isEmpty()
    got = {x.wallet: (x.trade_count, x.max_drawdown, x.alpha) for x in spark.read.parquet(paths[2]).where("batch_id = 15").collect()}
    assert got == {x.wallet: (x.trade_count, x.max_drawdown, x.alpha) for x in wallet_scores(spark.createDataFrame(everything, schema), None, 2, 1).collect()}


def test_stream_keys_stay_few_files_and_a_failed_write_is_counted(spark, tmp_path, monkeypatch):
    """Batches of one day add keys that are compacted; a write that fails gives send_failures, its retry none."""
    paths = [str(tmp_path / k) for k in ("valid", "dlq", "metrics")]
    monkeypatch.setattr(J, "KEY_FILES", 3)
    fn = J.quality_batch(*paths, core.DQ_CFG, "2024-01-01")
    for epoch in range(6):
        fn(spark.createDataFrame([(str(i), _payload(i, 60 * epoch + i)) for i in (epoch, epoch - 1)], "key string, value string"), epoch)
    files = list((tmp_path / "valid_keys").glob("day=*/*.parquet"))
    assert len(files) <= 5
    assert sorted(int(r.event_id) for r in spark.read.parquet(paths[0]).collect()) == [-1, 0, 1, 2, 3, 4, 5]
    real, broken = J._write, []

    def write(df, path, by=()):
        if "valid" in path and not broken:
            broken.append(path)
            raise OSError("no space")
        real(df, path, by)
    monkeypatch.setattr(J, "_write", write)
    last = spark.createDataFrame([("70", _payload(70, 5000)), ("71", "{")], "key string, value string")
    delivery = lambda: spark.read.parquet(paths[2]).where("batch_id = 6").select("processed", "records_sent", "valid_sent", "dlq_sent", "send_failures").first()
    try:
        fn(last, 6)
        raise AssertionError("the batch must fail")
    except OSError:
        assert tuple(delivery()) == (2, 1, 0, 1, 1)
    fn(last, 6)
    assert tuple(delivery()) == (2, 2, 1, 1, 0)


def test_lineage_lookups_read_the_days_asked_for(spark, tmp_path):
    alerts = serve.small_alerts(spark, SF_SMALL)
    path = str(tmp_path / "lineage")
    L.write_lineage(alerts, path)
    table = spark.read.parquet(path)
    one = table.where("alert_type = 'whale_trade'").orderBy("detected_at").first()
    found = L.lin_by_correlation(table, one.correlation_id, since=one.detected_at, until=one.detected_at)
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "dt" in scan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in scan
    assert one.alert_id in {r.alert_id for r in found.collect()}
    trades = A.trades_e(spark, SF_SMALL)
    kinds = {r.alert_type for r in L.lin_trace_raw(table, trades).select("alert_type").distinct().collect()}
    assert kinds == {r.alert_type for r in alerts.select("alert_type").distinct().collect()}
    assert L.lin_trace_raw(alerts, trades).count() == alerts.count()


def test_a_stream_without_alerts_gives_an_empty_result(spark, tmp_path):
    """Stores that no alert has reached, or no batch."""
    from tradewatch.suite.streams import _routed
    none = serve.small_alerts(spark, SF_SMALL).limit(0)
    columns = ["alert_id", "alert_type", "symbol", "severity", "detected_at", "lineage_module", "in_hot"]
    for base in ("none", "never"):
        hot, cold = (str(tmp_path / base / k) for k in ("hot", "cold"))
        if base == "none":
            SK.route_alerts(none, hot, cold, 0)
        r = _routed(spark, str(tmp_path / base))
        assert r.columns == columns and r.count() == 0


def test_slices_are_written_by_several_tasks(spark, monkeypatch):
    """All cores write a slice; a micro-batch takes its files, and the slices come in the order of time."""
    from tradewatch.suite import streams as ST
    monkeypatch.setattr(ST, "FILE_ROWS", 50)
    path = ST._in_slices(spark, SF_SMALL, "sliced_test", lambda: A.trades_e(spark, SF_SMALL), F.col("timestamp"))
    rows = spark.read.parquet(path)
    per = F.element_at(F.split(F.input_file_name(), "/"), -1)
    got = rows.groupBy(per.alias("f")).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).orderBy("hi").collect()
    n = len(got) // ST.SLICES
    assert n > 1 and len(got) == n * ST.SLICES and rows.count() == A.trades_e(spark, SF_SMALL).count()
    parts = [got[i * n:(i + 1) * n] for i in range(ST.SLICES)]
    assert all(max(x.hi for x in a) < min(x.lo for x in b) for a, b in zip(parts, parts[1:], strict=False))


def test_wallet_summaries_of_a_batch_are_few_files(spark, tmp_path):
    from tradewatch.streaming.wallet_state import MONTH_PARTS, wallet_alpha_batch
    schema = "wallet long, blockchain string, ts timestamp, event_id string, ret double"
    rows = [(w, "solana", T0 + dt.timedelta(minutes=w), f"{w}", 0.1) for w in range(400)]
    paths = [str(tmp_path / k) for k in ("trades", "segments", "scores")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wallet_alpha_batch(*paths)(spark.createDataFrame(rows, schema), 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 < len(list((tmp_path / "segments").glob("month=*/*.parquet"))) <= MONTH_PARTS


WALLET_ROWS = "wallet long, blockchain string, ts timestamp, event_id string, ret double"


def _wallet_stream(spark, tmp_path, **options):
    """The batch function, its folders, and its last scores beside those of the batch operator."""
    from tradewatch.operators.wallet import wallet_scores
    from tradewatch.streaming.wallet_state import wallet_alpha_batch
    paths = [str(tmp_path / k) for k in ("trades", "segments", "scores")]
    plain = lambda df: {x.wallet: (x.trade_count, x.wins, x.max_drawdown, x.alpha, x.last_event_id) for x in df.collect()}

    def both(rows, epoch):
        want = wallet_scores(spark.createDataFrame(rows, WALLET_ROWS), None, options["days"], options["min_trades"])
        return plain(spark.read.parquet(paths[2]).where(f"batch_id = {epoch}")), plain(want)
    return wallet_alpha_batch(*paths, **options), both


def test_a_batch_needs_no_older_trades_of_days_with_few(spark, tmp_path):
    """A day with few trades is kept as its trades: a batch that adds to it reads no older trades."""
    import shutil
    fn, both = _wallet_stream(spark, tmp_path, days=30, min_trades=1)
    rows = [(w, "solana", T0 + dt.timedelta(hours=3 * i), f"{i}", ((i * 7 + w) % 5 - 2) / 10) for w in range(3) for i in range(16)]
    for epoch in range(2):
        fn(spark.createDataFrame(rows[epoch::2], WALLET_ROWS), epoch)  # both bring trades of the same days
        for old in (tmp_path / "trades").glob(f"month=*/batch_id={epoch}"):
            shutil.rmtree(old)
    got, want = both(rows, 1)
    assert got == want and len(got) == 3


def test_wallet_days_with_many_trades_are_summed_whole(spark, tmp_path):
    """Days that turn from few trades to many, stay many, come late, or come twice."""
    import random

    from tradewatch.streaming.wallet_state import UNITS, latest_segments
    fn, both = _wallet_stream(spark, tmp_path, days=30, min_trades=1, compact_after=20)
    r = random.Random(7)
    at = lambda: T0 + dt.timedelta(days=r.randrange(3), minutes=r.randrange(1440))
    parts = [[(w, "solana", at(), f"{k}-{i}", round(r.uniform(-1, 1), 3)) for w in range(3) for i in range(n)]
             for k, n in enumerate((2, 5 * UNITS, 3, 4 * UNITS))]
    parts[2] += [(7, "solana", T0, f"{i // 2}", (i % 4 - 1) / 8) for i in range(2 * UNITS)]  # ids repeat
    parts[3] += [(None, "solana", T0, "x", 0.5), (8, "solana", T0, "y", None), (9, "solana", T0 + dt.timedelta(hours=1), "z", -0.25)]
    known = []
    for epoch in (0, 1, 2, 1, 3, 3):
        fn(spark.createDataFrame(parts[epoch], WALLET_ROWS), epoch)
        known += parts[epoch] * (parts[epoch][0] not in known)
        if epoch < 2 or epoch == 3:
            got, want = both([x for x in known if x[0] not in (None, 7)], epoch)
            assert {k: v for k, v in got.items() if k != 7} == want
    assert got[7][0] == 2 * UNITS and set(got) == {0, 1, 2, 7, 8, 9}
    state = spark.read.parquet(str(tmp_path / "segments"))
    assert {x.whole for x in state.select("whole").distinct().collect()} == {0, 1}
    assert latest_segments(state).groupBy("wallet", "_tb").count().where("count > 1").isEmpty()
    assert latest_segments(state).agg(F.sum("trade_count")).first()[0] == sum(x[0] is not None for p in parts for x in p)


def test_compacting_a_month_keeps_the_other_months(spark, tmp_path):
    fn, both = _wallet_stream(spark, tmp_path, days=90, min_trades=1, compact_after=3)
    rows = [(w, "solana", T0 + dt.timedelta(hours=w), f"{w}", 0.1 - w % 2 / 4) for w in range(4)]
    fn(spark.createDataFrame(rows, WALLET_ROWS), 0)
    for epoch in range(1, 8):  # the next month is compacted, some of its days are touched again
        more = [(w, "solana", T0 + dt.timedelta(days=40 + epoch % 3, hours=w), f"{epoch}-{w}", (epoch % 3 - 1) / 10) for w in range(4)]
        fn(spark.createDataFrame(more, WALLET_ROWS), epoch)
        rows += more
    got, want = both(rows, 7)
    assert got == want and all(v[0] == 8 for v in got.values())
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "segments").glob("month=*")}
    assert len(files) == 2 and max(files.values()) < 7
