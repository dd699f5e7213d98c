"""MOD-010 predictive scoring: a feature grid per (15 minutes,
symbol) filled as of each window's end from the other modules' outputs, point-in-time
accuracy of past cases, a logistic score with fixed coefficients (R10) and alerts. Every
window here runs on grid rows (time span / width per symbol), never on raw trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.operators.alerts import alert_build, alert_union
from tradewatch.operators.backtest import bt_price_asof
from tradewatch.operators.windows import asof_fill, running_mean_before

# Our coefficients per horizon (the reference gives none, R10):
# intercept, consensus/100, alpha percentile, volume (|z| / 3.5, at most 1), flow
# (|2 ratio - 1|), past accuracy.
COEFFICIENTS = {
    "p_1h": (-2.0, 2.5, 0.5, 0.8, 1.2, 1.0),
    "p_2h": (-1.8, 2.2, 0.5, 0.7, 1.1, 1.0),
    "p_4h": (-1.5, 2.0, 0.4, 0.6, 1.0, 1.0),
}
NEUTRAL = {"consensus_score": 0.0, "alpha_pct": 0.5, "z_score": 0.0, "flow_ratio": 0.5, "accuracy": 0.5}


def pred_grid(trades: DataFrame, width_s: int = 900) -> DataFrame:
    """window_start, window_end, symbol: every evaluation window from a symbol's first trade to its last."""
    us = width_s * 1_000_000
    at = lambda c: (F.floor(F.unix_micros(c) / F.lit(us)) * F.lit(us)).cast("long")
    span = trades.groupBy("symbol").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).where("lo IS NOT NULL")
    g = span.select("symbol", F.explode(F.sequence(at("lo"), at("hi"), F.lit(us).cast("long"))).alias("t"))
    return g.select(F.timestamp_micros("t").alias("window_start"), F.timestamp_micros(F.col("t") + F.lit(us)).alias("window_end"), "symbol")


def pred_features(grid: DataFrame, consensus: DataFrame, zscores: DataFrame, flows: DataFrame, alpha: DataFrame) -> DataFrame:
    """The feature vector at the end of every grid window, each feature as last known then: the
    score of the last closed consensus window, the largest |z| of the last scored volume window, the
    ratio of the last closed flow window, and the alpha percentile of the last scoring run
    (``alpha``: symbol, scored_at, alpha_pct). What is not known yet is neutral.

    volume_signal = min(|z| / 3.5, 1) and flow_signal = |2 ratio - 1| as in the consensus (R8)."""
    at = lambda df, t, v: df.select("symbol", F.col(t).alias("at"), v.alias("value"))
    f = asof_fill(grid, "window_end", {
        "consensus_score": at(consensus, "window_end", F.col("consensus_score")), "z_score": at(zscores, "window_end", F.abs("z_score")),
        "flow_ratio": at(flows, "window_end", F.col("flow_ratio")), "alpha_pct": at(alpha, "scored_at", F.col("alpha_pct"))}, ["symbol"])
    known = {n: F.coalesce(n, F.lit(NEUTRAL[n])) for n in ("consensus_score", "z_score", "flow_ratio", "alpha_pct")}
    f = f.select("window_start", "window_end", "symbol", *[c.alias(n) for n, c in known.items()])
    return f.withColumn("volume_signal", F.least(F.col("z_score") / F.lit(3.5), F.lit(1.0))).withColumn(
        "flow_signal", F.abs(F.lit(2.0) * F.col("flow_ratio") - F.lit(1.0)))


def pred_outcomes(features: DataFrame, prices: DataFrame, horizon_s: int, move_pct: float = 2.0,
                  bucket_seconds: int | None = None) -> DataFrame:
    """``moved``: |close at window end + horizon / close at window end - 1|
    > move_pct %, with as-of closes (null without a later trade)."""
    pts = features.select("window_start", "symbol", F.lit(0).alias("leg"), F.col("window_end").alias("t")).unionByName(
        features.select("window_start", "symbol", F.lit(1).alias("leg"),
                        F.timestamp_micros(F.unix_micros("window_end") + F.lit(horizon_s * 1_000_000)).alias("t")))
    a = bt_price_asof(pts, prices, "t", bucket_seconds)
    g = a.groupBy("window_start", "symbol").agg(
        F.max(F.when(F.col("leg") == 0, F.col("asof_price"))).alias("close_0"),
        F.max(F.when(F.col("leg") == 0, F.col("t"))).alias("t0"),
        F.max(F.when(F.col("leg") == 1, F.col("asof_price"))).alias("close_h"),
        F.max(F.when(F.col("leg") == 1, F.col("asof_time"))).alias("time_h"))
    moved = F.abs(F.col("close_h") / F.col("close_0") - F.lit(1.0)) > F.lit(move_pct / 100.0)
    return g.select("window_start", "symbol", F.when(F.col("time_h") > F.col("t0"), moved).alias("moved"))


def pred_accuracy(features: DataFrame, outcomes: DataFrame, horizon_s: int, width_s: int, bucket_seconds: int = 86400) -> DataFrame:
    """Hit rate of past grid rows in the same feature buckets (consensus
    score in fifths, flow ratio in fifths) whose outcome was known before the
    current window started: outcome time = start + width + horizon <= now.

    The frame runs per (feature bucket, time slice) with prefix totals carried across slices
    (windows.running_mean_before), so no task holds a feature bucket's whole history."""
    d = features.join(outcomes, ["window_start", "symbol"], "left")
    d = d.withColumn("score_bucket", F.floor(F.col("consensus_score") / 20).cast("int")) \
         .withColumn("flow_bucket", F.floor(F.col("flow_ratio") * 5).cast("int")) \
         .withColumn("_t", F.unix_seconds("window_start"))
    out = running_mean_before(d.withColumn("_moved", F.col("moved").cast("double")),
                              ["score_bucket", "flow_bucket"], "_t", "_moved", width_s + horizon_s, bucket_seconds, "accuracy")
    return out.drop("_t", "_moved")


def pred_score(features: DataFrame, coef: dict | None = None) -> DataFrame:
    """p = 1 / (1 + exp(-x)) per horizon, x linear in the features; missing
    accuracy is neutral. Native expressions only (no UDF)."""
    coef = coef or COEFFICIENTS
    acc = F.coalesce(F.col("accuracy"), F.lit(NEUTRAL["accuracy"]))
    out = features
    for name, (b0, b1, b2, b3, b4, b5) in coef.items():
        x = (F.lit(b0) + F.lit(b1) * F.col("consensus_score") / F.lit(100.0) + F.lit(b2) * F.col("alpha_pct")
             + F.lit(b3) * F.col("volume_signal") + F.lit(b4) * F.col("flow_signal") + F.lit(b5) * acc)
        out = out.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))
    return out


def pred_alerts(scores: DataFrame, p: float = 0.7, delta: float = 0.1) -> DataFrame:
    """``high_probability_move`` (high) when p_1h > p; ``score_update`` (low)
    when p_1h moved more than ``delta`` since the symbol's previous window."""
    hi = scores.where(F.col("p_1h") > F.lit(p)).withColumn("severity", F.lit("high"))
    a1 = alert_build(hi, "MOD-010", "high_probability_move", "severity",
                     F.format_string("Move over 2 %% likely on %s", F.col("symbol")),
                     details_cols=["p_1h", "p_2h", "p_4h"], id_cols=[F.unix_seconds("window_start")],
                     detected_at="window_end", exchange=None)
    w = Window.partitionBy("symbol").orderBy("window_start")
    up = scores.withColumn("prev_p_1h", F.lag("p_1h").over(w)) \
        .where(F.abs(F.col("p_1h") - F.col("prev_p_1h")) > F.lit(delta)).withColumn("severity", F.lit("low"))
    a2 = alert_build(up, "MOD-010", "score_update", "severity",
                     F.format_string("Score update on %s", F.col("symbol")),
                     details_cols=["p_1h", "prev_p_1h"], id_cols=[F.unix_seconds("window_start")],
                     detected_at="window_end", exchange=None)
    return alert_union(a1, a2)
