"""Map the driver's tables onto the trade domain (FIXTURES.md section 4).

Every adapter is a projection/filter/join over a whole parquet table, so the
work grows with the data; Catalyst prunes the columns each query needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions.columns import iso_ms
from tradewatch.sources.tables import table

# Base prices per symbol used to derive trade prices from events.
BASE_PRICE = {"BTC-USDT": 67432.5, "ETH-USDT": 3200.0, "SOL-USDT": 150.0}


def _events_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def trades_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trade events from ``events`` (fine-grained time)."""
    ev = table(spark, sf_dir, "events")
    code = F.col("user_id") % 3
    k = _events_k()
    base = F.when(code == 0, F.lit(BASE_PRICE["BTC-USDT"])).when(code == 1, F.lit(BASE_PRICE["ETH-USDT"])).otherwise(
        F.lit(BASE_PRICE["SOL-USDT"]))
    ts = F.col("ts").cast("timestamp")
    out = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 2 == 0, "binance").otherwise("coinbase").alias("exchange"),
        F.when(code == 0, "BTC-USDT").when(code == 1, "ETH-USDT").otherwise("SOL-USDT").alias("symbol"),
        (base * (F.lit(9950) + k) / F.lit(10000.0)).alias("price"),
        F.col("value").alias("quantity"),
        F.when(F.col("event_id") % 3 == 0, "sell").otherwise("buy").alias("side"),
        ts.alias("timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + k.cast("long") * 5_000_000).alias("ingestion_timestamp"),
    )
    return out.withColumn("quote_volume", F.col("price") * F.col("quantity")).select(
        "event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side", "timestamp",
        "ingestion_timestamp")


def trades_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trades from ``lineitem`` (bulk, day grain) with a return column."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate").cast("timestamp")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        F.when(F.col("l_linestatus") == "F", "binance").otherwise("coinbase").alias("exchange"),
        F.when(F.col("l_returnflag") == "A", "BTC-USDT").when(F.col("l_returnflag") == "N", "ETH-USDT")
        .otherwise("SOL-USDT").alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("quote_volume"),
        F.when(F.col("l_discount") > F.col("l_tax"), "buy").otherwise("sell").alias("side"),
        ts.alias("timestamp"),
        ts.alias("ingestion_timestamp"),
        (F.col("l_discount") - F.col("l_tax")).alias("ret"),
        F.col("l_orderkey"),
    )


def wallet_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with a wallet (the order's customer) and a chain."""
    li = trades_l(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("wallet"),
        F.when(F.col("o_custkey") % 2 == 0, "ethereum").otherwise("solana").alias("blockchain"),
        "event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side",
        F.col("timestamp").alias("ts"), "ret",
    )


def wallet_trades_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wallet trades laid over the days of ``events``: a ship date's day number since 1992
    times 17 minutes, from 2024-01-01 on (seven years in one month)."""
    day = F.datediff(F.to_date("ts"), F.lit("1992-01-01").cast("date"))
    start = F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    return wallet_trades(spark, sf_dir).withColumn("ts", F.timestamp_micros(start + day.cast("long") * F.lit(17 * 60 * 1_000_000)))


def wallet_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    return cu.where(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_custkey").alias("wallet"), F.col("c_name").alias("label"),
        F.col("c_mktsegment").alias("entity_type"))


def onchain_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-chain events from ``orders``: swaps on two routers, the rest transfers."""
    o = table(spark, sf_dir, "orders")
    wallets = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).scalar()
    prio = F.col("o_orderpriority")
    kind = F.when(prio.isin("1-URGENT", "2-HIGH"), "swap").otherwise("transfer")
    protocol = F.when(prio == "1-URGENT", "uniswap").when(prio == "2-HIGH", "jupiter")
    chain = (F.when(prio == "1-URGENT", "ethereum").when(prio == "2-HIGH", "solana")
             .when(F.col("o_custkey") % 2 == 0, "ethereum").otherwise("solana"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("tx"),
        chain.alias("blockchain"),
        F.col("o_custkey").alias("from_wallet"),
        ((F.col("o_custkey") * 7) % wallets).alias("to_wallet"),
        kind.alias("kind"),
        protocol.alias("protocol"),
        F.col("o_totalprice").alias("value_usd"),
        F.col("o_orderdate").cast("timestamp").alias("block_timestamp"),
    )


def dex_swaps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swap events with their decoded parameters packed as JSON (one row per
    line of a swap order)."""
    sw = onchain_raw(spark, sf_dir).where(F.col("kind") == "swap")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_extendedprice",
        "l_returnflag")
    j = sw.join(li, sw.tx.cast("long") == li.l_orderkey)
    pair = F.when(F.col("l_returnflag") == "A", "WBTC-USDC").when(F.col("l_returnflag") == "N", "WETH-USDC") \
        .otherwise("SOL-USDC")
    params = F.to_json(F.struct(
        pair.alias("pair"),
        F.col("l_quantity").alias("amount_in"),
        (F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("amount_out"),
        F.col("l_extendedprice").alias("amount_usd"),
    ))
    # (order, line) repeats in lineitem: the leg id adds part and supplier
    leg = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")
    return j.select("tx", F.col("l_linenumber").alias("log_index"), leg.alias("leg_id"), "blockchain", "protocol",
                    F.col("block_timestamp").alias("swap_timestamp"), params.alias("params"))


# ---- raw wire formats derived from trades_e ----------------------------------------

def _raw_symbol(symbol: F.Column) -> F.Column:
    return F.regexp_replace(symbol, "-", "")


def raw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue A trade messages for even event ids; every 4th id in the combined
    feed envelope. Column ``value`` holds the JSON text."""
    t = trades_e(spark, sf_dir).where(F.col("event_id").cast("long") % 2 == 0)
    body = F.struct(
        F.lit("trade").alias("e"),
        F.unix_millis("ingestion_timestamp").alias("E"),
        _raw_symbol(F.col("symbol")).alias("s"),
        F.col("event_id").cast("long").alias("t"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.unix_millis("timestamp").alias("T"),
        (F.col("side") == "sell").alias("m"),
        F.lit(True).alias("M"),
    )
    env = F.struct(F.concat(F.lower(_raw_symbol(F.col("symbol"))), F.lit("@trade")).alias("stream"), body.alias("data"))
    value = F.when(F.col("event_id").cast("long") % 4 == 0, F.to_json(env)).otherwise(F.to_json(body))
    return t.select(F.col("event_id").alias("key"), value.alias("value"))


def raw_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue B feed for odd event ids: match messages (every 5th a last_match)
    plus a heartbeat after every 17th id."""
    t = trades_e(spark, sf_dir).where(F.col("event_id").cast("long") % 2 == 1)
    n = F.col("event_id").cast("long")
    match = F.to_json(F.struct(
        F.when(n % 5 == 0, "last_match").otherwise("match").alias("type"),
        n.alias("trade_id"),
        (n * 10).alias("sequence"),
        F.concat(F.lit("m-"), F.col("event_id")).alias("maker_order_id"),
        F.concat(F.lit("t-"), F.col("event_id")).alias("taker_order_id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.regexp_replace("symbol", "-USDT$", "-USD").alias("product_id"),
        F.col("quantity").cast("string").alias("size"),
        F.col("price").cast("string").alias("price"),
        F.col("side"),
    ))
    beat = F.to_json(F.struct(F.lit("heartbeat").alias("type"), (n * 10 + 1).alias("sequence")))
    msgs = F.when(n % 17 == 0, F.array(match, beat)).otherwise(F.array(match))
    return t.select(F.col("event_id").alias("key"), F.explode(msgs).alias("value"))


def raw_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified-event JSON payloads with injected faults (by event id):
    %37 price null, %41 negative quantity, %43 unknown symbol, %47 unknown
    exchange, %53 bad side, %59 repeated 10 s later, %61 cut-short JSON,
    %67 quote_volume off by 1 %, %71 infinite price, %73 a quantity beyond any exact sum."""
    t = trades_e(spark, sf_dir)
    n = F.col("event_id").cast("long")
    rows = t.select(
        "event_id",
        F.when(n % 47 == 0, "kraken").otherwise(F.col("exchange")).alias("exchange"),
        F.when(n % 43 == 0, "DOGE-XYZ").otherwise(F.col("symbol")).alias("symbol"),
        F.when(n % 37 != 0, F.when(n % 71 == 0, F.lit(float("inf"))).otherwise(F.col("price"))).alias("price"),
        F.when(n % 41 == 0, -F.col("quantity")).when(n % 73 == 0, F.lit(1e30)).otherwise(F.col("quantity")).alias("quantity"),
        F.when(n % 67 == 0, F.col("quote_volume") * F.lit(1.01)).otherwise(F.col("quote_volume")).alias("quote_volume"),
        F.when(n % 53 == 0, "hold").otherwise(F.col("side")).alias("side"),
        "timestamp", "ingestion_timestamp",
        F.explode(F.when(n % 59 == 0, F.array(F.lit(0), F.lit(10))).otherwise(F.array(F.lit(0)))).alias("shift"),
    )
    shift = F.col("shift").cast("long") * 1_000_000
    payload = F.to_json(F.struct(
        "event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side",
        iso_ms(F.timestamp_micros(F.unix_micros("timestamp") + shift)).alias("timestamp"),
        iso_ms(F.timestamp_micros(F.unix_micros("ingestion_timestamp") + shift)).alias("ingestion_timestamp"),
    ))
    value = F.when(n % 61 == 0, F.substring(payload, 1, 25)).otherwise(payload)
    return rows.select(F.col("event_id").alias("key"), value.alias("value"))


def onchain_eth_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain A events as JSON: epoch-second block times."""
    o = onchain_raw(spark, sf_dir).where(F.col("blockchain") == "ethereum")
    return o.select(F.to_json(F.struct(
        F.col("tx").alias("hash"), F.col("from_wallet").alias("from"), F.col("to_wallet").alias("to"),
        "value_usd", "kind", "protocol", F.unix_seconds("block_timestamp").alias("block_time"))).alias("value"))


def onchain_sol_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain B events as JSON with other field names and ISO slot times."""
    o = onchain_raw(spark, sf_dir).where(F.col("blockchain") == "solana")
    return o.select(F.to_json(F.struct(
        F.col("tx").alias("signature"), F.col("from_wallet").alias("signer"), F.col("to_wallet").alias("receiver"),
        F.col("value_usd").alias("amount_usd"), F.col("kind").alias("type"), F.col("protocol").alias("program"),
        iso_ms("block_timestamp").alias("slot_time"))).alias("value"))
