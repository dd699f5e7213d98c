"""MOD-008 on-chain events and MOD-009 DEX swaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.columns import money
from tradewatch.operators.alerts import alert_build
from tradewatch.operators.windows import bucketed_prev

EVENT_COLS = ["tx", "blockchain", "from_wallet", "to_wallet", "kind", "protocol", "value_usd", "block_timestamp"]

ETH_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()), T.StructField("from", T.LongType()), T.StructField("to", T.LongType()),
    T.StructField("value_usd", T.DoubleType()), T.StructField("kind", T.StringType()),
    T.StructField("protocol", T.StringType()), T.StructField("block_time", T.LongType()),
])
SOL_SCHEMA = T.StructType([
    T.StructField("signature", T.StringType()), T.StructField("signer", T.LongType()),
    T.StructField("receiver", T.LongType()), T.StructField("amount_usd", T.DoubleType()),
    T.StructField("type", T.StringType()), T.StructField("program", T.StringType()),
    T.StructField("slot_time", T.StringType()),
])
SWAP_PARAMS = T.StructType([
    T.StructField("pair", T.StringType()), T.StructField("amount_in", T.DoubleType()),
    T.StructField("amount_out", T.DoubleType()), T.StructField("amount_usd", T.DoubleType()),
])


def onchain_normalise(eth: DataFrame, sol: DataFrame, value_col: str = "value") -> DataFrame:
    """Chain A (epoch-second blocks) and chain B (ISO slot times) JSON rows to
    one event schema."""
    e = eth.select(F.from_json(value_col, ETH_SCHEMA).alias("m")).select(
        F.col("m.hash").alias("tx"), F.lit("ethereum").alias("blockchain"), F.col("m.from").alias("from_wallet"),
        F.col("m.to").alias("to_wallet"), F.col("m.kind").alias("kind"), F.col("m.protocol").alias("protocol"),
        F.col("m.value_usd").alias("value_usd"), F.timestamp_seconds("m.block_time").alias("block_timestamp"))
    s = sol.select(F.from_json(value_col, SOL_SCHEMA).alias("m")).select(
        F.col("m.signature").alias("tx"), F.lit("solana").alias("blockchain"), F.col("m.signer").alias("from_wallet"),
        F.col("m.receiver").alias("to_wallet"), F.col("m.type").alias("kind"), F.col("m.program").alias("protocol"),
        F.col("m.amount_usd").alias("value_usd"),
        F.try_to_timestamp(F.regexp_replace("m.slot_time", "Z$", "")).alias("block_timestamp"))
    return e.unionByName(s)


def routers_frame(spark, routers) -> DataFrame:
    return spark.createDataFrame([(r,) for r in routers], "protocol string")


def onchain_swap_filter(df: DataFrame, routers: DataFrame, medium_usd: float = 100000) -> DataFrame:
    """Swaps through known routers (semi join with the router table, a
    configured list and so a fixed bound) as ``dex_swap`` alerts."""
    s = df.where(F.col("kind") == "swap").join(F.broadcast(routers), "protocol", "left_semi")
    s = s.withColumn("severity", F.when(F.col("value_usd") > F.lit(medium_usd), "medium").otherwise("low"))
    s = s.withColumn("symbol", F.lit(None).cast("string"))
    msg = F.format_string("Swap of %d USD via %s on %s", F.floor("value_usd").cast("long"), F.col("protocol"),
                          F.col("blockchain"))
    return alert_build(s, "MOD-008", "dex_swap", "severity", msg,
                       details_cols=["tx", "protocol", "blockchain", "value_usd"],
                       id_cols=["blockchain", "tx"], detected_at="block_timestamp", exchange=None)


def onchain_large_transfer(df: DataFrame, usd: float = 50000, high_usd: float = 1000000) -> DataFrame:
    t = df.where((F.col("kind") == "transfer") & (F.col("value_usd") > F.lit(usd)))
    t = t.withColumn("severity", F.when(F.col("value_usd") > F.lit(high_usd), "high").otherwise("medium"))
    t = t.withColumn("symbol", F.lit(None).cast("string"))
    msg = F.format_string("Transfer of %d USD on %s", F.floor("value_usd").cast("long"), F.col("blockchain"))
    return alert_build(t, "MOD-008", "large_transfer", "severity", msg,
                       details_cols=["tx", "blockchain", ("from_wallet", F.col("from_wallet").cast("string")),
                                     ("to_wallet", F.col("to_wallet").cast("string")), "value_usd"],
                       id_cols=["blockchain", "tx"], detected_at="block_timestamp", exchange=None)


def onchain_known_wallet(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Events whose sender or receiver is labelled: one lookup for each side,
    against distinct wallets, so that no event comes twice."""
    lab = labels.select("wallet").distinct()
    j = df.join(lab.withColumnRenamed("wallet", "_f"), F.col("from_wallet") == F.col("_f"), "left") \
          .join(lab.withColumnRenamed("wallet", "_t"), F.col("to_wallet") == F.col("_t"), "left")
    return j.where(F.col("_f").isNotNull() | F.col("_t").isNotNull()).drop("_f", "_t")


def dex_decode(df: DataFrame, params_col: str = "params") -> DataFrame:
    """Decoded swap: pair, amounts and effective price (USD per unit out)."""
    p = df.withColumn("_p", F.from_json(params_col, SWAP_PARAMS))
    return p.select(*[c for c in df.columns if c != params_col],
                    F.col("_p.pair").alias("pair"), F.col("_p.amount_in").alias("amount_in"),
                    F.col("_p.amount_out").alias("amount_out"), F.col("_p.amount_usd").alias("amount_usd"),
                    F.try_divide(F.col("_p.amount_usd"), F.col("_p.amount_out")).alias("effective_price"))


def dex_volume(swaps: DataFrame, width: str = "60 seconds") -> DataFrame:
    g = swaps.groupBy(F.window("swap_timestamp", width).alias("w"), "pair", "protocol").agg(
        F.sum(money("amount_usd")).cast("double").alias("volume_usd"), F.count(F.lit(1)).alias("swap_count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pair", "protocol",
                    "volume_usd", "swap_count")


def dex_price_impact(swaps: DataFrame, bucket_seconds: int | None = None) -> DataFrame:
    """impact = (price - previous price) / previous price per (pair,
    protocol) in (time, tx, leg) order (R11). The lag runs per segment
    of a pair's order with the previous segment's last price carried in, so a busy pair
    is spread over many tasks."""
    # leg ids repeat where lineitem repeats a whole row; the amounts complete
    # a total order (rows equal in all of these are interchangeable)
    d = bucketed_prev(swaps, ["pair", "protocol"], ["swap_timestamp", "tx", "leg_id", "amount_usd", "amount_in"],
                      ["effective_price"],
                      "swap_timestamp", bucket_seconds)
    return d.withColumn("price_impact", F.try_divide(F.col("effective_price") - F.col("prev_effective_price"),
                                                     F.col("prev_effective_price")))


def dex_large_swaps(swaps: DataFrame, usd: float = 100000, high_usd: float = 1000000) -> DataFrame:
    """``large_dex_swap`` for swaps above ``usd`` (with their price impact)."""
    s = swaps.where(F.col("amount_usd") > F.lit(usd))
    s = s.withColumn("severity", F.when(F.col("amount_usd") > F.lit(high_usd), "high").otherwise("medium"))
    s = s.withColumn("symbol", F.col("pair"))
    msg = F.format_string("Swap of %d USD on %s via %s", F.floor("amount_usd").cast("long"), F.col("pair"),
                          F.col("protocol"))
    return alert_build(s, "MOD-009", "large_dex_swap", "severity", msg,
                       details_cols=["tx", "leg_id", "amount_usd", "price_impact", "protocol"],
                       id_cols=["protocol", "tx", "leg_id"], detected_at="swap_timestamp", exchange=None)


def dex_liquidity(swaps: DataFrame, width: str = "60 seconds") -> DataFrame:
    """Net amount added per (window, pair, protocol), the running pool
    liquidity and its change against the previous window. The windows run on
    the per-window aggregate (one row per window and pool)."""
    g = swaps.groupBy(F.window("swap_timestamp", width).alias("w"), "pair", "protocol").agg(
        F.sum(money("amount_in") - money("amount_out")).alias("_net"),
        F.max(F.struct("swap_timestamp", "tx", "leg_id", "blockchain")).alias("_last"))
    w = Window.partitionBy("pair", "protocol").orderBy("window_start")
    d = g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pair", "protocol", "_net", "_last")
    d = d.withColumn("_liq", F.sum("_net").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_prev", F.lag("_liq").over(w))
    return d.select("window_start", "window_end", "pair", "protocol", F.col("_net").cast("double").alias("net_change"),
                    F.col("_liq").cast("double").alias("liquidity"), F.col("_prev").cast("double").alias("prev_liquidity"),
                    (F.try_divide(F.col("_net").cast("double"), F.abs(F.col("_prev").cast("double"))) * F.lit(100.0))
                    .alias("change_pct"), F.col("_last.swap_timestamp").alias("last_timestamp"),
                    F.concat_ws("/", "_last.tx", "_last.leg_id").alias("last_event_id"), F.col("_last.blockchain").alias("last_blockchain"))


def dex_liquidity_change(swaps: DataFrame, width: str = "60 seconds", pct: float = 50.0,
                         high_pct: float = 100.0, lineage=None) -> DataFrame:
    """``liquidity_change`` when the pool moves by more than ``pct`` percent.
    ``lineage`` (rows to rows) may add the lineage of a row's latest swap."""
    d = dex_liquidity(swaps, width).where(F.abs("change_pct") > F.lit(pct))
    d = lineage(d) if lineage else d
    d = d.withColumn("severity", F.when(F.abs("change_pct") > F.lit(high_pct), "high").otherwise("medium"))
    d = d.withColumn("symbol", F.col("pair"))
    msg = F.format_string("Liquidity of %s on %s changed by more than %s %%", F.col("pair"), F.col("protocol"),
                          F.lit(str(pct)))
    return alert_build(d, "MOD-009", "liquidity_change", "severity", msg,
                       details_cols=["change_pct", "liquidity", "prev_liquidity", "protocol"],
                       id_cols=["protocol", F.unix_seconds("window_start")], detected_at="window_end", exchange=None)
