"""Serving queries and monitors (SURVEY 2.11).

Top-k queries sort only their filtered rows and keep limit + 1 of them
(TakeOrderedAndProject), so no full sort of the alert table happens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.functions.columns import money

MAX_LIMIT = 200


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def alerts_query(alerts: DataFrame, alert_type=None, symbol=None, since=None, limit: int = 50, as_of=None) -> DataFrame:
    """Filter by type, symbol and time, newest first, at most ``limit`` rows
    (capped at 200) plus ``has_more``. Type and day (``dt``, where the table has
    it) are partition columns, so the scan prunes. Without ``since`` it is 24 hours
    before ``as_of`` (default: now)."""
    if since is None:
        since = (F.current_timestamp() if as_of is None else _ts(as_of)) - F.expr("INTERVAL 24 HOURS")
    limit = max(1, min(int(limit), MAX_LIMIT))
    a = alerts
    if alert_type is not None:
        a = a.where(F.col("alert_type") == alert_type)
    if symbol is not None:
        a = a.where(F.col("symbol") == symbol)
    if "dt" in a.columns:
        a = a.where(F.col("dt").cast("date") >= F.to_date(_ts(since)))
    a = a.where(F.col("detected_at") >= _ts(since))
    order = [F.col("detected_at").desc(), F.col("alert_id").desc()]
    # one top-k of limit + 1 rows; whether the last one exists is told from those rows
    top = a.orderBy(*order).limit(limit + 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    return top.withColumn("has_more", F.col("_n") > F.lit(limit)).drop("_n").orderBy(*order).limit(limit)


def metrics_symbol(trades: DataFrame, spreads: DataFrame, alerts: DataFrame, as_of=None) -> DataFrame:
    """Per (symbol, exchange): last price, 1 h volume; per symbol: latest
    spread, anomaly count in 24 h, last whale time, size, price, quantity and side. ``as_of``
    defaults to the latest trade (a scalar subquery, computed once)."""
    clock = trades.agg(F.max("timestamp")).scalar() if as_of is None else _ts(as_of)
    t = trades.where(F.col("timestamp") <= clock)
    hour_ago = clock - F.expr("INTERVAL 1 HOUR")
    venue = t.groupBy("symbol", "exchange").agg(
        F.max_by("price", F.struct("timestamp", "event_id")).alias("last_price"),
        F.coalesce(F.sum(F.when(F.col("timestamp") > hour_ago, money("quote_volume"))),
                   F.lit(0).cast("decimal(38,8)")).cast("double").alias("volume_1h"))
    sp = spreads.where(F.col("window_end") <= clock).groupBy("symbol").agg(
        F.max_by("spread_pct", "window_start").alias("last_spread_pct"))
    day_ago = clock - F.expr("INTERVAL 24 HOURS")
    al = alerts.where(F.col("detected_at") <= clock).groupBy("symbol").agg(
        F.count(F.when(F.col("detected_at") > day_ago, 1)).alias("anomaly_count_24h"),
        F.max(F.when(F.col("alert_type") == "whale_trade", F.col("detected_at"))).alias("last_whale_at"),
        F.max_by(F.when(F.col("alert_type") == "whale_trade", F.col("details")),
                 F.when(F.col("alert_type") == "whale_trade", F.struct("detected_at", "alert_id"))).alias("_whale"))
    whale = F.from_json("_whale", "quote_volume double, price double, quantity double, side string")
    al = al.withColumn("_w", whale).select(
        "symbol", "anomaly_count_24h", "last_whale_at", F.col("_w.quote_volume").alias("last_whale_usd"),
        F.col("_w.price").alias("last_whale_price"), F.col("_w.quantity").alias("last_whale_quantity"),
        F.col("_w.side").alias("last_whale_side"))
    return venue.join(sp, "symbol", "left").join(al, "symbol", "left").withColumn("updated_at", clock)


def board_volume(agg: DataFrame, alerts: DataFrame) -> DataFrame:
    """Volume per (symbol, exchange, window) with an anomaly marker from the
    volume alerts (left join on the window's key and end)."""
    va = alerts.where(F.col("alert_type") == "volume_spike").select(
        "symbol", "exchange", F.col("detected_at").alias("window_end"), F.col("severity").alias("anomaly_severity"))
    j = agg.join(va, ["symbol", "exchange", "window_end"], "left")
    return j.select("window_start", "window_end", "symbol", "exchange", "window_volume", "trade_count",
                    F.col("anomaly_severity").isNotNull().alias("is_anomaly"), "anomaly_severity")


def board_spread(spreads: DataFrame) -> DataFrame:
    return spreads.select("window_start", "symbol", "exchange_a", "exchange_b", "spread_pct",
                          (F.abs("spread_pct") > 0.5).alias("above_threshold"))


def board_whales(whales: DataFrame, n: int = 50) -> DataFrame:
    """Whale log: newest first, top n (TakeOrdered)."""
    return (whales.select("timestamp", "exchange", "symbol", "side", "quote_volume", "event_id")
            .orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(n))


def board_health(trades: DataFrame) -> DataFrame:
    """Per venue: record count, last event, ingestion lag (max and mean, s)."""
    lag = (F.unix_micros("ingestion_timestamp") - F.unix_micros("timestamp")) / F.lit(1_000_000)
    return trades.groupBy("exchange").agg(
        F.count(F.lit(1)).alias("records"), F.max("timestamp").alias("last_seen"),
        F.max(lag).alias("max_lag_s"), F.avg(lag).alias("avg_lag_s"))


# ---- monitors --------------------------------------------------------------------------------

def metrics_counts(alerts: DataFrame, width: str = "1 hour") -> DataFrame:
    g = alerts.groupBy(F.window("detected_at", width).alias("w"), "module_id").agg(
        F.count(F.lit(1)).alias("alert_count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "module_id",
                    "alert_count")


def period_series(series: DataFrame, period_seconds: int, key_cols=(), order_col: str = "window_start", until=None) -> DataFrame:
    """The series with a row for every period from a key's first to its last one (or to ``until``, for a
    feed that has stopped); ``missing`` tells the rows that were added, whose values are null.
    A key has (time span / period) rows."""
    key, us = list(key_cols), period_seconds * 1_000_000
    last = F.max(order_col) if until is None else F.greatest(F.max(order_col), until if isinstance(until, Column) else F.lit(until).cast("timestamp"))
    span = series.where(F.col(order_col).isNotNull()).groupBy(*key).agg(F.unix_micros(F.min(order_col)).alias("_lo"), F.unix_micros(last).alias("_hi"))
    cal = span.where("_hi IS NOT NULL").select(*key, F.explode(F.sequence("_lo", "_hi", F.lit(us).cast("long"))).alias("_at"))
    have = series.select(*[F.col(c).alias("_k" + c) for c in key], *[c for c in series.columns if c not in key], F.lit(True).alias("_has"))
    same = F.unix_micros(have[order_col]) == cal["_at"]
    for c in key:
        same = same & cal[c].eqNullSafe(have["_k" + c])
    j = cal.join(have, same, "left")
    return j.select(*key, F.timestamp_micros("_at").alias(order_col), *[c for c in series.columns if c not in (*key, order_col)],
                    F.col("_has").isNull().alias("missing"))


MISSING = ("breaching", "not_breaching", "ignore")


def alarm_m_of_n(series: DataFrame, value_col: str, threshold: float, m: int, n: int, below: bool = True,
                 key_cols=(), order_col: str = "window_start", period_seconds: int | None = None, missing: str = "not_breaching",
                 until=None) -> DataFrame:
    """``breach`` per period; ``alarm`` when at least m of the last n
    consecutive periods (this one included) breach. The window holds one
    series (periods = time span / width).

    With ``period_seconds`` the series is filled first, so that n rows are n consecutive periods, and a period
    without data (or with a null value) counts by the rule ``missing``: as a breach, as none, or not at all: the
    last n periods that have data count then. Without it the rows given are the periods."""
    if missing not in MISSING:
        raise ValueError(f"missing is one of {MISSING}")
    v = F.col(value_col)
    breach = (v < F.lit(threshold)) if below else (v > F.lit(threshold))
    if period_seconds is not None:
        series = period_series(series, period_seconds, key_cols, order_col, until)
    d = series.withColumn("breach", F.coalesce(breach, F.lit(missing == "breaching" and period_seconds is not None)))
    if period_seconds is not None and missing == "ignore":
        # the last n rows with data, at every row: the n-th latest position that has data bounds the frame
        seen = Window.partitionBy(*key_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn("_seen", F.count(value_col).over(seen))
        last = Window.partitionBy(*key_cols).orderBy("_seen").rangeBetween(-(n - 1), 0)
        d = d.withColumn("breaches_in_n", F.sum(F.when(v.isNotNull() & F.col("breach"), 1).otherwise(0).cast("long")).over(last)).drop("_seen")
        return d.withColumn("alarm", F.col("breaches_in_n") >= F.lit(m))
    w = Window.partitionBy(*key_cols).orderBy(order_col).rowsBetween(-(n - 1), 0)
    return d.withColumn("breaches_in_n", F.sum(F.col("breach").cast("long")).over(w)).withColumn(
        "alarm", F.col("breaches_in_n") >= F.lit(m))


def lag_monitor(df: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Ingestion minus event time per (window, venue): max, mean and the exact
    p95 (the value of rank ceil(0.95 n)). Trades are first counted per (window, venue,
    lag); the cumulative count runs over those rows, one per distinct lag."""
    lag = F.unix_micros("ingestion_timestamp") - F.unix_micros("timestamp")
    c = df.where(lag.isNotNull()).groupBy(F.window("timestamp", width).alias("w"), "exchange", lag.alias("_us")).agg(F.count(F.lit(1)).alias("_k"))
    key = Window.partitionBy("w", "exchange")
    c = c.withColumn("_up_to", F.sum("_k").over(key.orderBy("_us"))).withColumn("_n", F.sum("_k").over(key))
    s = F.lit(1_000_000)
    g = c.groupBy("w", "exchange").agg(
        F.sum("_k").alias("records"), (F.max("_us") / s).alias("max_lag_s"),
        (F.sum(F.col("_us") * F.col("_k")) / F.sum("_k") / s).alias("avg_lag_s"),
        (F.min(F.when(F.col("_up_to") >= F.ceil(F.col("_n") * F.lit(0.95)), F.col("_us"))) / s).alias("p95_lag_s"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "exchange", "records",
                    "max_lag_s", "avg_lag_s", "p95_lag_s")
