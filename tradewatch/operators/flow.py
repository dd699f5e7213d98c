"""MOD-006 flow direction and MOD-007 consensus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.columns import money
from tradewatch.operators.alerts import alert_build


def flow_aggregate(whales: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Buy and sell whale volume per (window, symbol); net and
    ratio = buy / (buy + sell). Exact decimal sums."""
    qv = money("quote_volume")
    zero = F.lit(0).cast("decimal(38,8)")
    g = whales.groupBy(F.window("timestamp", width).alias("w"), "symbol").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "buy", qv)), zero).alias("_buy"),
        F.coalesce(F.sum(F.when(F.col("side") == "sell", qv)), zero).alias("_sell"),
        F.count(F.lit(1)).alias("whale_count"),
        F.max(F.struct("timestamp", "exchange", "event_id")).alias("_last"),
    )
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol",
        F.col("_buy").cast("double").alias("buy_volume"), F.col("_sell").cast("double").alias("sell_volume"),
        (F.col("_buy") - F.col("_sell")).cast("double").alias("net_flow"),
        F.try_divide(F.col("_buy").cast("double"), (F.col("_buy") + F.col("_sell")).cast("double")).alias("flow_ratio"),
        "whale_count", F.col("_last.event_id").alias("last_event_id"), F.col("_last.timestamp").alias("last_timestamp"),
        F.col("_last.exchange").alias("last_exchange"))


def flow_alerts(flows: DataFrame, hi: float = 0.7, lo: float = 0.3, strong_hi: float = 0.85,
                strong_lo: float = 0.15) -> DataFrame:
    """ratio > hi: accumulation_signal; ratio < lo: distribution_signal."""
    r = F.col("flow_ratio")
    f = flows.where((r > F.lit(hi)) | (r < F.lit(lo)))
    f = f.withColumn("alert_type", F.when(r > F.lit(hi), "accumulation_signal").otherwise("distribution_signal"))
    f = f.withColumn("severity", F.when((r > F.lit(strong_hi)) | (r < F.lit(strong_lo)), "high").otherwise("medium"))
    msg = F.format_string("%s on %s: %d buy vs %d sell USD", F.col("alert_type"), F.col("symbol"),
                          F.floor("buy_volume").cast("long"), F.floor("sell_volume").cast("long"))
    return alert_build(f, "MOD-006", F.col("alert_type"), "severity", msg,
                       details_cols=["flow_ratio", "buy_volume", "sell_volume", "net_flow", "whale_count"],
                       id_cols=[F.unix_seconds("window_start")], detected_at="window_end", exchange=None)


SEVERITY_STRENGTH = {"medium": 0.5, "high": 0.75, "critical": 1.0}


def _alert_ref(df: DataFrame):
    return F.col("alert_id") if "alert_id" in df.columns else F.lit(None).cast("string")


def _signal_rows(vol_scored: DataFrame, whales: DataFrame, flows: DataFrame, width: str) -> DataFrame:
    """The three inputs in one shape: window_start, symbol, v, w, buy, sell, alert_id,
    and the time and id of the event behind the row."""
    none, nil = F.lit(None).cast("double"), F.lit(None).cast("decimal(28,8)")

    def win(col):
        return F.window(col, width).start.alias("window_start")

    def event(df, ts):
        at = F.col(ts) if ts in df.columns else F.lit(None).cast("timestamp")
        eid = next((F.col(c) for c in ("last_event_id", "event_id") if c in df.columns), F.lit(None).cast("string"))
        exch = F.col("exchange") if "exchange" in df.columns else F.col("last_exchange") if "last_exchange" in df.columns \
            else F.lit(None).cast("string")
        return F.struct(at.alias("timestamp"), eid.cast("string").alias("event_id"), exch.alias("exchange")).alias("event")

    strength = reduce(lambda acc, kv: acc.when(F.col("severity") == kv[0], F.lit(kv[1])),
                      list(SEVERITY_STRENGTH.items())[1:],
                      F.when(F.col("severity") == "medium", F.lit(SEVERITY_STRENGTH["medium"])))
    v = vol_scored.where(F.col("severity").isNotNull()).select(
        win("window_start"), "symbol", F.least(F.abs("z_score") / F.lit(3.5), F.lit(1.0)).alias("v"), none.alias("w"),
        nil.alias("buy"), nil.alias("sell"), _alert_ref(vol_scored).alias("alert_id"), event(vol_scored, "last_timestamp"))
    w = whales.select(win("timestamp"), "symbol", none.alias("v"), strength.alias("w"), nil.alias("buy"), nil.alias("sell"),
                      _alert_ref(whales).alias("alert_id"), event(whales, "timestamp"))
    f = flows.select(win("window_start"), "symbol", none.alias("v"), none.alias("w"), money("buy_volume").alias("buy"),
                     money("sell_volume").alias("sell"), _alert_ref(flows).alias("alert_id"), event(flows, "last_timestamp"))
    return v.unionByName(w).unionByName(f)


def consensus_signals(vol_scored: DataFrame, whales: DataFrame, flows: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One row per (window, symbol) with any signal: volume strength
    v = min(max |z| / 3.5, 1) over flagged volume windows, whale strength w by
    worst severity (0.5, 0.75, 1), flow strength f = |2 ratio - 1| (R8), where
    ratio is that of all flow in the window. The three inputs are unioned and
    grouped once (one shuffle, no joins); missing signals are 0. ``contributing``
    counts the alerts behind the row; ``consensus_contributions`` lists them."""
    g = _signal_rows(vol_scored, whales, flows, width).groupBy("window_start", "symbol").agg(
        F.coalesce(F.max("v"), F.lit(0.0)).alias("volume_signal"),
        F.coalesce(F.max("w"), F.lit(0.0)).alias("whale_signal"),
        F.sum("buy").alias("_buy"), F.sum("sell").alias("_sell"),
        F.count("alert_id").alias("contributing"), F.max("event").alias("_event"))
    ratio = F.try_divide(F.col("_buy").cast("double"), (F.col("_buy") + F.col("_sell")).cast("double"))
    end = F.col("window_start") + F.expr(f"INTERVAL {width}")
    return g.withColumn("flow_ratio", ratio).select(
        "window_start", end.alias("window_end"), "symbol", "volume_signal", "whale_signal",
        F.coalesce(F.abs(F.lit(2.0) * F.col("flow_ratio") - F.lit(1.0)), F.lit(0.0)).alias("flow_signal"), "flow_ratio", "contributing",
        F.col("_event.timestamp").alias("last_timestamp"), F.col("_event.event_id").alias("last_event_id"),
        F.col("_event.exchange").alias("last_exchange"))


def consensus_contributions(vol_scored: DataFrame, whales: DataFrame, flows: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One row per alert behind a consensus row: window_start, symbol, alert_id."""
    return _signal_rows(vol_scored, whales, flows, width).where(F.col("alert_id").isNotNull()).select("window_start", "symbol", "alert_id")


def consensus_score(sig: DataFrame, weights=(0.3, 0.3, 0.4)) -> DataFrame:
    wv, ww, wf = weights
    s = F.lit(100.0) * (F.lit(wv) * F.col("volume_signal") + F.lit(ww) * F.col("whale_signal")
                        + F.lit(wf) * F.col("flow_signal"))
    return sig.withColumn("consensus_score", s)


def consensus_alerts(scored: DataFrame, threshold: float = 70, high: float = 85) -> DataFrame:
    """score > threshold: bullish when flow ratio > 0.5, bearish when < 0.5;
    no alert at exactly 0.5 or without flow. High above ``high``."""
    r = F.col("flow_ratio")
    d = scored.where((F.col("consensus_score") > F.lit(threshold)) & r.isNotNull() & (r != 0.5))
    d = d.withColumn("alert_type", F.when(r > 0.5, "consensus_bullish").otherwise("consensus_bearish"))
    d = d.withColumn("severity", F.when(F.col("consensus_score") > F.lit(high), "high").otherwise("medium"))
    msg = F.format_string("%s on %s", F.col("alert_type"), F.col("symbol"))
    return alert_build(d, "MOD-007", F.col("alert_type"), "severity", msg,
                       details_cols=["consensus_score", "volume_signal", "whale_signal", "flow_signal",
                                     ("contributing_alerts", F.col("contributing"))],
                       id_cols=[F.unix_seconds("window_start")], detected_at="window_end", exchange=None)
