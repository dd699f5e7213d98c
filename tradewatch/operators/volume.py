"""MOD-001 volume anomaly: tumbling windows, a rolling baseline
over earlier windows, z-scores and alerts.

The baseline runs on window aggregates, never on raw trades. Its range frame
is evaluated per (key, time bucket) with a halo of earlier rows, so a hot
symbol spreads over many tasks (windows.halo_rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.functions.columns import iso_ms, lin_correlation_id, money, money_sum
from tradewatch.operators.alerts import alert_build
from tradewatch.operators.windows import halo_rows

DEFAULT_KEYS = ("symbol", "exchange")


def _latest(col: str) -> F.Column:
    return F.max_by(col, F.struct("timestamp", "event_id"))


def vol_aggregate(df: DataFrame, width: str = "60 seconds", keys=DEFAULT_KEYS) -> DataFrame:
    """Sum of quote volume and trade count per (window, key). Each window also
    carries its latest contributing event for lineage (R17) and its first and
    last price (direction of the window)."""
    g = df.groupBy(F.window("timestamp", width).alias("w"), *keys).agg(
        money_sum("quote_volume").alias("window_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        _latest("event_id").alias("last_event_id"),
        F.max("timestamp").alias("last_timestamp"),
        F.min_by("price", F.struct("timestamp", "event_id")).alias("open_price"),
        _latest("price").alias("close_price"),
    )
    out = g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                   "window_volume", "trade_count", "last_event_id", "last_timestamp", "open_price", "close_price")
    if "exchange" in keys:
        out = out.withColumn("correlation_id", lin_correlation_id("exchange", "symbol", iso_ms("last_timestamp")))
    return out


def _zero_fill(agg: DataFrame, keys, width_seconds: int) -> DataFrame:
    w_us = width_seconds * 1_000_000
    t = F.unix_micros("window_start")
    bounds = agg.groupBy(*keys).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    cal = bounds.select(*keys, F.explode(F.sequence("lo", "hi", F.lit(w_us).cast("long"))).alias("_t"))
    have = agg.withColumn("_t", t)
    full = cal.join(have, [*keys, "_t"], "left")
    return full.select(
        *keys, F.timestamp_micros("_t").alias("window_start"), F.timestamp_micros(F.col("_t") + w_us).alias("window_end"),
        F.coalesce("window_volume", F.lit(0.0)).alias("window_volume"),
        F.coalesce("trade_count", F.lit(0)).alias("trade_count"),
        *[c for c in agg.columns if c not in (*keys, "window_start", "window_end", "window_volume", "trade_count")])


def vol_baseline(agg: DataFrame, seconds: int = 3600, min_windows: int = 5, keys=DEFAULT_KEYS,
                 zero_fill: bool = False, width_seconds: int | None = None) -> DataFrame:
    """Rolling mean and sample stddev of window_volume over the earlier windows
    of the same key within ``seconds`` before each window start (the current
    window excluded, R3). Fewer than ``min_windows`` earlier windows gives a
    null baseline. The mean is an exact decimal sum over a count."""
    keys = list(keys)
    if zero_fill:
        agg = _zero_fill(agg, keys, width_seconds or 60)
    d = agg.withColumn("_t", F.unix_seconds("window_start"))
    d = halo_rows(d, "_t", seconds, bucket=max(seconds * 4, 86400))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_t").rangeBetween(-seconds, -1)
    n = F.count(F.lit(1)).over(w)
    mean = F.sum(money("window_volume")).over(w).cast("double") / n
    sd = F.stddev_samp("window_volume").over(w)
    enough = n >= F.lit(min_windows)
    out = d.select(*agg.columns, "_home", n.alias("n_prev"), F.when(enough, mean).alias("rolling_mean"),
                   F.when(enough, sd).alias("rolling_stddev"))
    return out.where("_home").drop("_home")


def vol_zscore(base: DataFrame, medium: float = 2.5, high: float = 3.5) -> DataFrame:
    """z = (window_volume - rolling_mean) / rolling_stddev; null when the
    stddev is null or 0. Severity on |z|: > high high, > medium medium."""
    sd = F.col("rolling_stddev")
    z = F.when(sd > 0, F.try_divide(F.col("window_volume") - F.col("rolling_mean"), sd))
    az = F.abs(F.col("z_score"))
    return (base.withColumn("z_score", z)
            .withColumn("severity", F.when(az > F.lit(high), "high").when(az > F.lit(medium), "medium"))
            .withColumn("direction", F.when(F.col("z_score") > 0, "up").when(F.col("z_score") < 0, "down")))


def vol_detect(df: DataFrame, cfg: dict, width: str | None = None, seconds: int | None = None) -> DataFrame:
    c = cfg["volume_anomaly"]
    width = width or f"{c['window_seconds']} seconds"
    agg = vol_aggregate(df, width)
    base = vol_baseline(agg, seconds or c["rolling_window_seconds"], c["min_windows"])
    return vol_zscore(base, c["z_score_medium"], c["z_score_high"])


def vol_spike_alerts(scored: DataFrame, cfg: dict | None = None) -> DataFrame:
    """``volume_spike`` alerts for windows with a severity; the direction
    (up or down) goes into details (R4). Detected at the window end."""
    s = scored.where(F.col("severity").isNotNull())
    msg = F.format_string("Volume %s on %s %s: %d USD in window", F.col("direction"), F.col("exchange"),
                          F.col("symbol"), F.floor("window_volume").cast("long"))
    return alert_build(
        s, "MOD-001", "volume_spike", "severity", msg,
        details_cols=["z_score", "window_volume", "rolling_mean", "rolling_stddev",
                      ("window_start", iso_ms("window_start")), "direction", "trade_count"],
        id_cols=[F.unix_seconds("window_start")], detected_at="window_end")
