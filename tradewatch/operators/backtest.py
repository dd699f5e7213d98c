"""MOD-011 back-testing: as-of prices, forward returns and the
report per (module, symbol, horizon).

The as-of lookup is a union of points and prices ordered by time, with
``last(price, ignorenulls)`` per (symbol, segment) and the previous
segment's last price carried in (windows.bucketed_last): no range join, no
task holding a whole symbol, however its trades lie in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.operators.alerts import alert_build
from tradewatch.operators.windows import bucketed_last, max_drawdown

GROUP = ["module_id", "symbol", "horizon_s"]

# Predicted direction per alert type (R12); volume_spike and whale_trade take
# theirs from the row (price direction of the window, trade side).
DIRECTION = {"accumulation_signal": 1, "consensus_bullish": 1, "distribution_signal": -1, "consensus_bearish": -1}


def bt_price_asof(points: DataFrame, prices: DataFrame, t_col: str = "t", bucket_seconds: int | None = None,
                  keys=("symbol",)) -> DataFrame:
    """Add ``asof_price`` and ``asof_time``: the last trade at or before
    ``t_col`` of the same key (ties: the larger event id)."""
    keys = list(keys)
    px = prices.select(*keys, F.col("timestamp").alias("_ts"), F.lit(0).alias("_kind"),
                       F.col("event_id").cast("string").alias("_tie"),
                       F.struct(F.col("price").alias("price"), F.col("timestamp").alias("time")).alias("_pv"))
    pcols = [c for c in points.columns if c not in keys]
    pt = points.select(*keys, F.col(t_col).alias("_ts"), F.lit(1).alias("_kind"), F.lit("").alias("_tie"),
                       F.lit(None).cast("struct<price:double,time:timestamp>").alias("_pv"),
                       F.struct(*pcols).alias("_point"))
    u = px.withColumn("_point", F.lit(None).cast(pt.schema["_point"].dataType)).unionByName(pt)
    filled = bucketed_last(u, keys, ["_ts", "_kind", "_tie"], "_pv", "_ts", bucket_seconds, "_asof")
    out = filled.where(F.col("_kind") == 1)
    return out.select(*keys, "_point.*", F.col("_asof.price").alias("asof_price"),
                      F.col("_asof.time").alias("asof_time"))


def bt_forward_return(alerts: DataFrame, prices: DataFrame, horizons=(3600, 14400, 86400),
                      bucket_seconds: int | None = None) -> DataFrame:
    """One row per (alert, horizon): entry price at the alert, exit price at
    alert + horizon (null unless a trade came after the alert), return,
    signed return (times ``direction``) and hit."""
    hs = F.array(*[F.lit(0)] + [F.lit(int(h)) for h in horizons])
    pts = alerts.select("alert_id", "module_id", "alert_type", "symbol", "detected_at", "direction",
                        F.explode(hs).alias("horizon_s"))
    pts = pts.withColumn("t", F.timestamp_micros(F.unix_micros("detected_at") + F.col("horizon_s").cast("long")
                                                 * 1_000_000))
    a = bt_price_asof(pts, prices, "t", bucket_seconds)
    # entry and exits of an alert in one aggregate (one shuffle on alert_id)
    keep = ["alert_id", "module_id", "alert_type", "symbol", "detected_at", "direction"]
    legs = [F.max(F.when(F.col("horizon_s") == 0, F.col("asof_price"))).alias("entry_price")]
    legs += [F.max(F.when(F.col("horizon_s") == int(h), F.struct(F.lit(int(h)).alias("horizon_s"),
                                                                  F.col("asof_price").alias("p"),
                                                                  F.col("asof_time").alias("pt"))))
             .alias(f"_h{int(h)}") for h in horizons]
    g = a.groupBy(*keep).agg(*legs)
    j = g.select(*keep, "entry_price", F.explode(F.array(*[f"_h{int(h)}" for h in horizons])).alias("x"))
    j = j.select(*keep, "x.horizon_s", "entry_price",
                 F.when(F.col("x.pt") > F.col("detected_at"), F.col("x.p")).alias("exit_price"))
    ret = F.try_divide(F.col("exit_price"), F.col("entry_price")) - F.lit(1.0)
    j = j.withColumn("ret", ret).withColumn("signed_return", F.col("direction").cast("double") * F.col("ret"))
    return j.select("alert_id", "module_id", "alert_type", "symbol", "detected_at", "direction", "horizon_s",
                    "entry_price", "exit_price", "ret", "signed_return",
                    (F.col("signed_return") > 0).alias("hit"))


def bt_hit_rate(r: DataFrame) -> DataFrame:
    """Share of alerts (with a direction and an exit) whose call came true."""
    return r.groupBy(*GROUP).agg(F.avg(F.col("hit").cast("double")).alias("hit_rate"),
                                 F.count("hit").alias("n_scored"))


def bt_avg_return(r: DataFrame) -> DataFrame:
    """Mean of exact decimal sums: the same digits in any order of the rows."""
    return _moments(r).select(*GROUP, "avg_return")


def bt_sharpe(r: DataFrame) -> DataFrame:
    return _moments(r).select(*GROUP, "sharpe")


RETURN_SUMS = [("_n", lambda s: F.when(s.isNotNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))), ("_s", lambda s: s),
               ("_ss", lambda s: (s * s).cast("decimal(28,18)"))]


def _return_sums():
    """(name, Column) of a group's count, sum and sum of squares of returns, as decimals."""
    s = F.col("signed_return").cast("decimal(20,12)")
    return [(n, f(s)) for n, f in RETURN_SUMS]


def _mean_and_sharpe():
    mean = F.try_divide(F.col("_s").cast("double"), F.col("_n"))
    spread = F.col("_ss").cast("double") - F.col("_s").cast("double") * mean
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(spread, F.col("_n") - 1)))
    return mean.alias("avg_return"), F.try_divide(mean, deviation).alias("sharpe")


def _moments(r: DataFrame) -> DataFrame:
    g = r.groupBy(*GROUP).agg(*[F.sum(c).alias(n) for n, c in _return_sums()])
    return g.select(*GROUP, *_mean_and_sharpe())


def bt_max_drawdown(r: DataFrame, bucket_seconds: int | None = None) -> DataFrame:
    s = r.where(F.col("signed_return").isNotNull())
    return max_drawdown(s, GROUP, ["detected_at", "alert_id"], "signed_return", "detected_at", bucket_seconds)


def bt_report(r: DataFrame, backtest_date, bucket_seconds: int | None = None) -> DataFrame:
    """All metrics from one bucketed pass over the returns. Mean and deviation
    come from exact decimal sums, so they do not depend on the order of the rows."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    g = max_drawdown(r, GROUP, ["detected_at", "alert_id"], "signed_return", "detected_at", bucket_seconds, sums=[
        ("n_alerts", one), ("n_scored", F.when(F.col("hit").isNotNull(), one).otherwise(none)),
        ("_hits", F.when(F.col("hit"), one).otherwise(none)), *_return_sums()])
    return g.select(*GROUP, "n_alerts", "n_scored", F.try_divide(F.col("_hits"), F.col("n_scored")).alias("hit_rate"),
                    *_mean_and_sharpe(), "max_drawdown", F.lit(backtest_date).cast("date").alias("backtest_date"))


def bt_direction_of(alerts: DataFrame) -> DataFrame:
    """Alerts of any module as back-test input; the direction is that of the alert type
    (``DIRECTION``), null for types that predict none."""
    kind = F.lit(None).cast("int")
    for name, d in DIRECTION.items():
        kind = F.when(F.col("alert_type") == name, d).otherwise(kind)
    return alerts.select("alert_id", "module_id", "alert_type", "symbol", "detected_at", kind.alias("direction"))


def bt_complete_alerts(report: DataFrame, lineage=None) -> DataFrame:
    """One ``backtest_complete`` (low) per module and back-test date. ``lineage`` (rows to
    rows) may add a row's lineage."""
    g = report.groupBy("module_id", "backtest_date").agg(F.sum("n_alerts").alias("n_alerts"),
                                                          F.avg("hit_rate").alias("mean_hit_rate"))
    g = g.withColumn("severity", F.lit("low")).withColumn("symbol", F.lit(None).cast("string")) \
        .withColumn("detected_at", F.col("backtest_date").cast("timestamp"))
    g = lineage(g) if lineage else g
    msg = F.format_string("Back-test of %s complete: %d alerts", F.col("tested_module"), F.col("n_alerts"))
    return alert_build(g.withColumnRenamed("module_id", "tested_module"), "MOD-011", "backtest_complete", "severity",
                       msg, details_cols=["tested_module", "n_alerts", "mean_hit_rate"],
                       id_cols=["tested_module", "backtest_date"], exchange=None)


def bt_daily_hit_rate(r: DataFrame) -> DataFrame:
    return r.withColumn("backtest_date", F.to_date("detected_at")).groupBy(*GROUP, "backtest_date").agg(
        F.avg(F.col("hit").cast("double")).alias("hit_rate"), F.count("hit").alias("n_scored"))


def bt_degradation(reports: DataFrame, drop: float = 0.1) -> DataFrame:
    """``signal_degradation`` (high) when a day's hit rate falls more than
    ``drop`` below the mean of the earlier report days of the same group.
    The window holds one group's report days (small)."""
    w = Window.partitionBy(*GROUP).orderBy("backtest_date").rowsBetween(Window.unboundedPreceding, -1)
    d = reports.withColumn("trailing_hit_rate", F.avg("hit_rate").over(w))
    d = d.where(F.col("hit_rate") < F.col("trailing_hit_rate") - F.lit(drop))
    d = d.withColumn("severity", F.lit("high")).withColumn("detected_at", F.col("backtest_date").cast("timestamp"))
    msg = F.format_string("Hit rate of %s on %s fell below its trailing mean", F.col("tested_module"),
                          F.col("symbol"))
    return alert_build(d.withColumnRenamed("module_id", "tested_module"), "MOD-011", "signal_degradation", "severity",
                       msg, details_cols=["tested_module", "horizon_s", "hit_rate", "trailing_hit_rate"],
                       id_cols=["tested_module", "horizon_s", "backtest_date"], exchange=None)
