"""The segmented window helpers give exactly the single-partition answer."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewatch.operators import windows as WH
from tradewatch.operators.volume import vol_baseline

SCHEMA = "k string, ts timestamp, id string, v double"


def _rows(seed, n=400, keys=("a", "b", "c")):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        day = rnd.randint(0, 60)
        sec = rnd.randint(0, 86399)
        v = None if rnd.random() < 0.2 else round(rnd.uniform(-5, 5), 2)
        out.append((rnd.choice(keys), f"2024-01-01 00:00:00", f"{i:05d}", v, day * 86400 + sec))
    return out


def _frame(spark, seed):
    rows = _rows(seed)
    df = spark.createDataFrame([(k, i, v, s) for k, _, i, v, s in rows], "k string, id string, v double, s long")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


@pytest.mark.parametrize("seed", [1, 2])
def test_bucketed_prev_equals_lag(spark, seed):
    df = _frame(spark, seed)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = {r.id: r.p for r in df.select("id", F.lag("v").over(w).alias("p")).collect()}
    got = {r.id: r.prev_v for r in WH.bucketed_prev(df, ["k"], ["ts", "id"], ["v"], "ts", 7 * 86400).collect()}
    assert got == want


@pytest.mark.parametrize("seed", [3, 4])
def test_bucketed_last_equals_last_ignorenulls(spark, seed):
    df = _frame(spark, seed)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.f for r in df.select("id", F.last("v", ignorenulls=True).over(w).alias("f")).collect()}
    got = {r.id: r.f for r in WH.bucketed_last(df, ["k"], ["ts", "id"], "v", "ts", 5 * 86400, "f").collect()}
    assert got == want


@pytest.mark.parametrize("seed", [5, 6])
def test_max_drawdown_equals_running_sums(spark, seed):
    df = _frame(spark, seed).where(F.col("v").isNotNull())
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("cum", F.sum(F.col("v").cast("decimal(38,12)")).over(w))
    d = d.withColumn("peak", F.greatest(F.lit(0).cast("decimal(38,12)"), F.max("cum").over(w)))
    want = {r.k: float(r.dd) for r in d.groupBy("k").agg(F.greatest(F.max(F.col("peak") - F.col("cum")),
                                                                     F.lit(0)).alias("dd")).collect()}
    got = {r.k: r.max_drawdown for r in WH.max_drawdown(df, ["k"], ["ts", "id"], "v", "ts", 6 * 86400).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("seed", [7, 8])
def test_distributed_percent_rank(spark, seed):
    df = _frame(spark, seed).withColumn("v", F.round("v", 0))  # many ties
    nn = df.where(F.col("v").isNotNull())
    want = {r.id: r.q for r in nn.select("id", F.percent_rank().over(Window.partitionBy("k").orderBy("v"))
                                              .alias("q")).collect()}
    got = {r.id: r.pr for r in WH.distributed_percent_rank(df, ["k"], "v", "pr", partitions=5).collect()
           if r.v is not None}
    assert got == pytest.approx(want)


def test_halo_baseline_equals_range_window(spark):
    rnd = random.Random(11)
    rows = [(s, e, i * 3600, float(rnd.randint(1, 1000))) for i in range(300) for s, e in (("X", "a"), ("Y", "b"))
            if rnd.random() < 0.7]
    df = spark.createDataFrame(rows, "symbol string, exchange string, t long, window_volume double") \
        .withColumn("window_start", F.timestamp_seconds("t")).drop("t")
    got = {(r.symbol, r.window_start): (r.n_prev, r.rolling_mean, r.rolling_stddev)
           for r in vol_baseline(df, 72 * 3600, 5).collect()}
    w = Window.partitionBy("symbol", "exchange").orderBy(F.unix_seconds("window_start")).rangeBetween(-72 * 3600, -1)
    ref = df.select("symbol", "window_start", F.count(F.lit(1)).over(w).alias("n"),
                    F.avg("window_volume").over(w).alias("m"), F.stddev_samp("window_volume").over(w).alias("s"))
    for r in ref.collect():
        n, m, s = got[(r.symbol, r.window_start)]
        assert n == r.n
        if r.n >= 5:
            assert m == pytest.approx(r.m) and (s == pytest.approx(r.s) if r.s is not None else s is None)
        else:
            assert m is None


@pytest.mark.parametrize("seed", [12, 13])
def test_running_mean_before_equals_range_frame(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("xy"), i * 3600 + rnd.randint(0, 3000), None if rnd.random() < 0.3 else float(rnd.randint(0, 1)))
            for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(Window.unboundedPreceding, -7200)
    want = {(r.k, r.t): r.a for r in df.select("k", "t", F.avg("v").over(w).alias("a")).collect()}
    got = {(r.k, r.t): r.a for r in WH.running_mean_before(df, ["k"], "t", "v", 7200, 5 * 86400, "a").collect()}
    assert got.keys() == want.keys()
    for key, val in want.items():
        assert (got[key] is None and val is None) or got[key] == pytest.approx(val)


def _hot(spark, n=3000):
    """One key has most rows, all within one minute, and many share a second; another key is null."""
    rnd = random.Random(21)
    rows = [(rnd.choice(["hot"] * 8 + ["a", None]), f"{i:05d}", None if rnd.random() < .3 else float(rnd.randint(-4, 4)), rnd.randint(0, 59)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, id string, v double, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")


def test_a_hot_minute_is_spread_over_the_segments(spark):
    sizes = [r["count"] for r in WH.time_segments(_hot(spark), ["k"], ["ts", "id"], 8).where("k = 'hot'").groupBy("_tb").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 3000 / 4


def test_segments_equal_plain_windows(spark):
    df = _hot(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("id", F.lag("v").over(w).alias("p"), F.last("v", ignorenulls=True).over(up).alias("f")).collect()
    assert {r.id: r.prev_v for r in WH.bucketed_prev(df, ["k"], ["ts", "id"], ["v"], "ts").collect()} == {r.id: r.p for r in plain}
    assert {r.id: r.f for r in WH.bucketed_last(df, ["k"], ["ts", "id"], "v", "ts", None, "f").collect()} == {r.id: r.f for r in plain}
    d = df.withColumn("cum", F.sum(F.col("v").cast("decimal(38,12)")).over(up))
    d = d.withColumn("peak", F.greatest(F.lit(0).cast("decimal(38,12)"), F.max("cum").over(up)))
    want = {r.k: float(r.dd) for r in d.groupBy("k").agg(F.greatest(F.max(F.col("peak") - F.col("cum")), F.lit(0)).alias("dd")).collect()}
    assert {r.k: r.max_drawdown for r in WH.max_drawdown(df, ["k"], ["ts", "id"], "v", "ts").collect()} == pytest.approx(want)


def test_only_large_keys_are_ranged(spark, monkeypatch):
    """Small keys cost no range partitioning; a large one is cut, with the same answer."""
    df, ranged = _hot(spark), []
    real = WH.time_segments
    monkeypatch.setattr(WH, "time_segments", lambda rows, *a, **k: ranged.append(1) or real(rows, *a, **k))
    dd = lambda: {r.k: (r.max_drawdown, r.n) for r in WH.max_drawdown(df, ["k"], ["ts", "id"], "v", "ts", sums=[("n", F.lit(1))]).collect()}
    plain = dd()
    assert not ranged and sum(n for _, n in plain.values()) == 3000
    monkeypatch.setattr(WH, "KEY_ROWS", 1000)
    assert dd() == plain and len(ranged) == 1
