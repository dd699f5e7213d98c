"""MOD-004 wallet scoring. Input rows: wallet, blockchain, ts,
event_id, ret (R9: win is ret > 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.functions.columns import ratio
from tradewatch.operators.alerts import alert_build
from tradewatch.operators import windows as WN
from tradewatch.operators.windows import combine_drawdown, distributed_percent_rank, drawdown_segments, max_drawdown, stored

KEYS = ["wallet", "blockchain"]
RET = "decimal(18,8)"


def _as_of(df: DataFrame, as_of) -> tuple[DataFrame, Column]:
    """Attach the scoring time. ``None`` means the latest trade time in the
    data (a scalar subquery, computed once)."""
    if as_of is None:
        return df.withColumn("_as_of", df.agg(F.max("ts")).scalar()), F.col("_as_of")
    at = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.withColumn("_as_of", at), F.col("_as_of")


def _recent(df: DataFrame, as_of, days: int) -> DataFrame:
    d, t = _as_of(df, as_of)
    lo = F.timestamp_micros(F.unix_micros(t) - F.lit(days * 86400 * 1_000_000))
    return d.where((F.col("ts") > lo) & (F.col("ts") <= t))


def _stats(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.count(F.when(F.col("ret") > 0, 1)).alias("wins"),
        F.sum(F.col("ret").cast(RET)).alias("_ret_sum"),
        F.max("_as_of").alias("scored_at"),
    ).select(*keys, "scored_at", "trade_count", "wins",
             (F.col("wins") / F.col("trade_count")).alias("win_rate"),
             (F.col("_ret_sum").cast("double") / F.col("trade_count")).alias("avg_return"))


def wallet_stats(df: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Per wallet over ``days`` up to ``as_of``: trade count, wins, win rate,
    average return (exact decimal sum over the count)."""
    return _stats(_recent(df, as_of, days), KEYS)


def wallet_drawdown(df: DataFrame, as_of=None, days: int = 30, bucket_seconds: int | None = None) -> DataFrame:
    """Largest fall of the cumulative return below its running peak (from 0),
    in (ts, event_id) order, per wallet."""
    r = _recent(df, as_of, days)
    return max_drawdown(r, KEYS, ["ts", "event_id"], "ret", "ts", bucket_seconds)


def wallet_alpha(stats: DataFrame, dd: DataFrame, min_trades: int = 5) -> DataFrame:
    """alpha = win_rate * avg_return * sqrt(n) / max_drawdown; null with fewer
    than ``min_trades`` trades or a zero drawdown (R9)."""
    keys = [k for k in stats.columns if k in dd.columns and k != "max_drawdown"]
    return _with_alpha(stats.join(dd, keys, "left"), min_trades)


def _with_alpha(j: DataFrame, min_trades: int) -> DataFrame:
    alpha = ratio(F.col("win_rate") * F.col("avg_return") * F.sqrt(F.col("trade_count").cast("double")),
                  F.col("max_drawdown"))
    return j.withColumn("alpha", F.when(F.col("trade_count") >= F.lit(min_trades), alpha))


SEGMENT_SUMS = [("trade_count", lambda: F.lit(1).cast("long")),
                ("wins", lambda: F.when(F.col("ret") > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))),
                ("_ret_sum", lambda: F.col("ret").cast(RET))]


def _figures() -> dict:
    return {"sums": [(n, c()) for n, c in SEGMENT_SUMS], "maxima": [("scored_at", F.col("_as_of")), ("_last", F.struct("ts", "event_id"))]}


def wallet_segments(df: DataFrame, keys, bucket_seconds: int | None) -> DataFrame:
    """Summaries per (key, segment): counts, returns, drawdown parts; needs ``_as_of``."""
    return drawdown_segments(df, keys, ["ts", "event_id"], "ret", "ts", bucket_seconds, **_figures())


def unit_segments(df: DataFrame) -> DataFrame:
    """Each trade as the summary of a segment of its own, with the ``_tb`` that it names; needs no shuffle."""
    return WN.unit_summaries(df, [*KEYS, "_tb"], "ret", [(n, c()) for n, c in SEGMENT_SUMS], [("scored_at", F.col("ts")), ("_last", F.struct("ts", "event_id"))])


def fold_units(units: DataFrame, keys) -> DataFrame:
    """``unit_segments`` of a key to the summary that ``wallet_segments`` gives."""
    return WN.fold_units(units, keys, ["_last"], [n for n, _ in SEGMENT_SUMS], ["scored_at", "_last"])


def scores_of_units(units: DataFrame, keys, min_trades: int, scored_at) -> DataFrame:
    """``unit_segments`` to scores as of ``scored_at``; a key's units meet in one window."""
    d = units.select(*keys, "_total", "wins", "_ret_sum", F.col("_last.ts").alias("ts"), F.col("_last.event_id").alias("event_id"))
    sums = [("trade_count", F.lit(1).cast("long")), ("wins", F.col("wins")), ("_ret_sum", F.col("_ret_sum"))]
    s = WN.drawdown_in_windows(d, keys, ["ts", "event_id"], "_total", sums=sums, maxima=[("_last", F.struct("ts", "event_id"))])
    return _scored(s.withColumn("scored_at", F.lit(scored_at)), keys, min_trades)


def scores_of_segments(seg: DataFrame, keys, min_trades: int, scored_at, order=("_tb",)) -> DataFrame:
    """Summaries, in ``order``, to scores as of ``scored_at``: one row per key with alpha and its latest event."""
    s = combine_drawdown(seg, keys, sums=[n for n, _ in SEGMENT_SUMS], maxima=["_last"], order=order)
    return _scored(s.withColumn("scored_at", F.lit(scored_at)), keys, min_trades)


def _scored(s: DataFrame, keys, min_trades: int, more=()) -> DataFrame:
    stats = s.select(*keys, "scored_at", "trade_count", "wins", (F.col("wins") / F.col("trade_count")).alias("win_rate"),
                     (F.col("_ret_sum").cast("double") / F.col("trade_count")).alias("avg_return"), "max_drawdown",
                     F.col("_last.ts").alias("last_timestamp"), F.col("_last.event_id").alias("last_event_id"), *more)
    return _with_alpha(stats, min_trades)


def _scores(df: DataFrame, keys, min_trades: int, bucket_seconds: int | None, sets=()) -> DataFrame:
    """Counts, returns and drawdown of each key from one pass, and alpha."""
    s = max_drawdown(df, keys, ["ts", "event_id"], "ret", "ts", bucket_seconds, **_figures(), sets=sets)
    return _scored(s, keys, min_trades, [n for n, _ in sets])


def wallet_scores(df: DataFrame, as_of=None, days: int = 30, min_trades: int = 5, bucket_seconds: int | None = None) -> DataFrame:
    """Scores of every wallet over ``days`` up to ``as_of`` (a time or a Column; None
    takes the latest trade, which reads the trades once more)."""
    return _scores(_recent(df, as_of, days), KEYS, min_trades, bucket_seconds)


def wallet_scores_periodic(df: DataFrame, width: str, min_trades: int = 5,
                           bucket_seconds: int | None = None, symbols: bool = False) -> DataFrame:
    """Scores per tumbling scoring period (``scored_at`` = period end): one
    scoring run per period, as a daily job would write them. With ``symbols`` a score
    tells which symbols the wallet traded in the period, each as a struct, for ``alpha_by_symbol``."""
    p = df.withColumn("_w", F.window("ts", width)).withColumn("_as_of", F.col("_w.end")) \
        .withColumn("period_start", F.col("_w.start")).drop("_w")
    keys = [*KEYS, "period_start"]
    return _scores(p, keys, min_trades, bucket_seconds, [("symbols", F.struct("symbol"))] if symbols else ())


def alpha_percentile(scores: DataFrame, out_col: str = "alpha_percentile") -> DataFrame:
    """percent_rank of alpha within (blockchain, scored_at), exact and without
    a single-partition window (windows.distributed_percent_rank). The scores are stored
    first: ranking and looking up read them, the trades are read once."""
    return distributed_percent_rank(stored(scores, "wallet-scores"), ["blockchain", "scored_at"], "alpha", out_col)


def alpha_by_symbol(ranked: DataFrame) -> DataFrame:
    """symbol, scored_at, alpha_pct: the mean alpha percentile of the wallets that traded the symbol in a scoring
    period, each wallet once; one without a name counts nowhere. ``ranked`` are periodic scores with ``symbols`` and their percentile."""
    known = ranked.dropna(subset=[*KEYS, "period_start", "alpha_percentile"]).select("scored_at", "alpha_percentile", F.explode("symbols").alias("s"))
    g = known.groupBy(F.col("s.symbol").alias("symbol"), "scored_at").agg(
        F.sum(F.col("alpha_percentile").cast("decimal(20,12)")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return g.select("symbol", "scored_at", (F.col("_s").cast("double") / F.col("_n")).alias("alpha_pct"))


def wallet_high_alpha(scores: DataFrame, pct: float = 0.95, high_pct: float = 0.99) -> DataFrame:
    """``high_alpha_wallet`` alerts for alpha above the ``pct`` percentile of
    its scoring run (high above ``high_pct``). The percentile is exact: the
    value of rank ceil(pct * n), by the distributed rank of the distinct values."""
    scores = stored(scores, "wallet-scores")  # read for ranks, sizes and alerts
    known = scores.where(F.col("alpha").isNotNull())
    ranked = distributed_percent_rank(known, ["scored_at"], "alpha", "_rank")
    sizes = known.groupBy("scored_at").agg(F.count(F.lit(1)).alias("_n"))
    below = F.round(F.col("_rank") * (F.col("_n") - 1))  # values strictly below
    at = lambda q: F.max(F.when(below < F.ceil(F.lit(q) * F.col("_n")), F.col("alpha")))
    th = ranked.join(sizes, "scored_at").groupBy("scored_at").agg(at(pct).alias("threshold"), at(high_pct).alias("high_threshold"))
    # one row per scoring run; AQE broadcasts it when its measured size allows
    j = scores.join(th, "scored_at").where(F.col("alpha") > F.col("threshold"))
    j = j.withColumn("severity", F.when(F.col("alpha") > F.col("high_threshold"), "high").otherwise("medium"))
    j = j.withColumn("symbol", F.lit(None).cast("string"))
    msg = F.format_string("Wallet %s on %s above the %s percentile of alpha", F.col("wallet").cast("string"),
                          F.col("blockchain"), F.lit(str(int(pct * 100))))
    return alert_build(j, "MOD-004", "high_alpha_wallet", "severity", msg,
                       details_cols=[("wallet", F.col("wallet").cast("string")), "blockchain", "alpha", "threshold",
                                     "trade_count"],
                       id_cols=[F.col("wallet"), F.col("blockchain"), F.unix_seconds("scored_at")],
                       detected_at="scored_at", exchange=None)


def wallet_score_change(scores: DataFrame, delta: float = 1.0) -> DataFrame:
    """``score_change`` (low) when alpha moves more than ``delta`` between a
    wallet's consecutive scoring runs. The window holds one wallet's runs."""
    w = Window.partitionBy(*KEYS).orderBy("scored_at")
    d = scores.withColumn("prev_alpha", F.lag("alpha").over(w))
    d = d.where(F.abs(F.col("alpha") - F.col("prev_alpha")) > F.lit(delta))
    d = d.withColumn("severity", F.lit("low")).withColumn("symbol", F.lit(None).cast("string"))
    msg = F.format_string("Wallet %s alpha moved by more than %s", F.col("wallet").cast("string"), F.lit(str(delta)))
    return alert_build(d, "MOD-004", "score_change", "severity", msg,
                       details_cols=[("wallet", F.col("wallet").cast("string")), "blockchain", "alpha", "prev_alpha"],
                       id_cols=[F.col("wallet"), F.col("blockchain"), F.unix_seconds("scored_at")],
                       detected_at="scored_at", exchange=None)
