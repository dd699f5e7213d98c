"""Venue messages -> unified trade events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.columns import (
    iso_ms, norm_epoch_ms, norm_ingest_stamp, norm_iso_ms, norm_quote_volume, norm_symbol, norm_symbol_usd,
)

# Venue A keys differ only by case (t/T, e/E, m/M) and Spark resolves names
# case-insensitively, so the struct holds the lower-case keys and the trade
# time T is read by (case-sensitive) JSON path.
VENUE_A_SCHEMA = T.StructType([
    T.StructField("e", T.StringType()), T.StructField("s", T.StringType()),
    T.StructField("t", T.LongType()), T.StructField("p", T.StringType()), T.StructField("q", T.StringType()),
    T.StructField("b", T.LongType()), T.StructField("a", T.LongType()), T.StructField("m", T.BooleanType()),
])

VENUE_B_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("trade_id", T.LongType()),
    T.StructField("sequence", T.LongType()), T.StructField("maker_order_id", T.StringType()),
    T.StructField("taker_order_id", T.StringType()), T.StructField("time", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("price", T.StringType()), T.StructField("side", T.StringType()),
])

TRADE_COLUMNS = ["event_id", "exchange", "symbol", "price", "quantity", "quote_volume", "side", "timestamp",
                 "ingestion_timestamp"]

MATCH_TYPES = ("match", "last_match")


def norm_unwrap(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Strip the combined-feed envelope: keep ``data`` when present."""
    return df.withColumn(value_col, F.coalesce(F.get_json_object(value_col, "$.data"), F.col(value_col)))


def norm_venue_a(df: DataFrame, exchange: str = "binance", ingested_at=None, value_col: str = "value") -> DataFrame:
    """Venue A trade JSON (already unwrapped) -> nine unified columns."""
    m = F.from_json(F.col(value_col), VENUE_A_SCHEMA).alias("m")
    trade_ms = F.get_json_object(F.col(value_col), "$.T").try_cast("long").alias("trade_ms")
    p = df.select(m, trade_ms).select("m.*", "trade_ms")
    price = F.col("p").try_cast("double")
    qty = F.col("q").try_cast("double")
    return p.select(
        F.col("t").cast("string").alias("event_id"),
        F.lit(exchange).alias("exchange"),
        norm_symbol("s").alias("symbol"),
        price.alias("price"),
        qty.alias("quantity"),
        norm_quote_volume(price, qty).alias("quote_volume"),
        F.when(F.col("m"), "sell").otherwise("buy").alias("side"),
        norm_epoch_ms("trade_ms").alias("timestamp"),
        norm_ingest_stamp(ingested_at).alias("ingestion_timestamp"),
    )


def norm_match_filter(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep only match and last_match messages (drops heartbeats, acks)."""
    return df.where(F.get_json_object(value_col, "$.type").isin(*MATCH_TYPES))


def norm_venue_b(df: DataFrame, exchange: str = "coinbase", ingested_at=None, value_col: str = "value") -> DataFrame:
    """Venue B match JSON -> nine unified columns (side passes through)."""
    m = F.from_json(F.col(value_col), VENUE_B_SCHEMA).alias("m")
    p = norm_match_filter(df, value_col).select(m).select("m.*")
    price = F.col("price").try_cast("double")
    qty = F.col("size").try_cast("double")
    return p.select(
        F.col("trade_id").cast("string").alias("event_id"),
        F.lit(exchange).alias("exchange"),
        norm_symbol_usd("product_id").alias("symbol"),
        price.alias("price"),
        qty.alias("quantity"),
        norm_quote_volume(price, qty).alias("quote_volume"),
        F.col("side"),
        norm_iso_ms("time").alias("timestamp"),
        norm_ingest_stamp(ingested_at).alias("ingestion_timestamp"),
    )


def norm_union(*dfs: DataFrame) -> DataFrame:
    """One stream from all venues; ``exchange`` tells them apart."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def norm_symbol_subset(df: DataFrame, symbols) -> DataFrame:
    return df.where(F.col("symbol").isin(list(symbols)))


def norm_payload(df: DataFrame) -> DataFrame:
    """Event -> (partition_key, payload JSON). The key keeps per-symbol order
    on a keyed sink; timestamps travel as ISO text with ms."""
    cols = [iso_ms(c).alias(c) if c in ("timestamp", "ingestion_timestamp") else F.col(c) for c in df.columns]
    return df.select(
        F.coalesce(F.col("symbol"), F.lit("unknown")).alias("partition_key"),
        F.to_json(F.struct(*cols)).alias("payload"),
    )
