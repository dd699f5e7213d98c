"""MOD-003 cross-venue spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.columns import iso_ms, money
from tradewatch.operators.alerts import alert_build


def vwap(df: DataFrame, width: str = "30 seconds") -> DataFrame:
    """sum(price * quantity) / sum(quantity) per (window, symbol, exchange),
    both sums exact (DECIMAL); partial aggregation runs before the shuffle. A trade
    whose product or quantity is no finite number in range is left out of both."""
    pq, q = money(F.col("price") * F.col("quantity")), money("quantity")
    g = df.groupBy(F.window("timestamp", width).alias("w"), "symbol", "exchange").agg(
        F.sum(F.when(q.isNotNull(), pq)).alias("_pq"),
        F.sum(F.when(pq.isNotNull(), q)).alias("_q"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max(F.struct("timestamp", "event_id")).alias("_last"),
    )
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", "exchange",
                    F.try_divide(F.col("_pq").cast("double"), F.col("_q").cast("double")).alias("vwap"), "trade_count",
                    F.col("_last.event_id").alias("last_event_id"), F.col("_last.timestamp").alias("last_timestamp"))


def spread(vwaps: DataFrame) -> DataFrame:
    """The widest pair of venues per (window, symbol): lowest and highest VWAP,
    put in name order; spread_pct = (vwap_a - vwap_b) / vwap_b * 100 (signed,
    R5). Venues of one VWAP are told apart by name. A one-venue window gives
    no row. One aggregation over the per-venue rows, linear in the venues."""
    v = F.struct("vwap", "exchange")
    last = F.max(F.struct("last_timestamp", "exchange", "last_event_id")) if "last_event_id" in vwaps.columns else None
    g = vwaps.where(F.col("vwap").isNotNull()).groupBy("window_start", "window_end", "symbol").agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), *([last.alias("last")] if last is not None else []))
    first = F.col("lo.exchange") < F.col("hi.exchange")
    a, b = (F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("lo", "hi"), ("hi", "lo")))
    out = g.where(F.col("lo.exchange") != F.col("hi.exchange")).withColumn("a", a).withColumn("b", b)
    pct = F.try_divide(F.col("a.vwap") - F.col("b.vwap"), F.col("b.vwap")) * F.lit(100.0)
    event = [F.col("last.last_timestamp").alias("last_timestamp"), F.col("last.exchange").alias("last_exchange"),
             F.col("last.last_event_id").alias("last_event_id")] if last is not None else []
    return out.select("window_start", "window_end", "symbol", F.col("a.exchange").alias("exchange_a"),
                      F.col("b.exchange").alias("exchange_b"), F.col("a.vwap").alias("vwap_a"), F.col("b.vwap").alias("vwap_b"),
                      pct.alias("spread_pct"), *event)


def spread_alerts(spreads: DataFrame, pct: float = 0.5, high: float = 1.0) -> DataFrame:
    """``spread_divergence`` when |spread| > pct; high above ``high``."""
    a = F.abs(F.col("spread_pct"))
    s = spreads.where(a > F.lit(pct)).withColumn("severity", F.when(a > F.lit(high), "high").otherwise("medium"))
    msg = F.format_string("Spread between %s and %s on %s over %s %%", F.col("exchange_a"), F.col("exchange_b"),
                          F.col("symbol"), F.lit(str(pct)))
    return alert_build(
        s, "MOD-003", "spread_divergence", "severity", msg,
        details_cols=["spread_pct", ("exchange_a_vwap", F.col("vwap_a")), ("exchange_b_vwap", F.col("vwap_b")),
                      "exchange_a", "exchange_b", ("window_start", iso_ms("window_start"))],
        id_cols=[F.unix_seconds("window_start"), "exchange_a", "exchange_b"], detected_at="window_end",
        exchange=None)


def spread_detect(df: DataFrame, cfg: dict, width: str | None = None) -> DataFrame:
    c = cfg["spread_calculator"]
    return spread(vwap(df, width or f"{c['window_seconds']} seconds"))
