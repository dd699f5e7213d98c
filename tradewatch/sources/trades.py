"""Sources: raw_trades reads with partition pruning, a JSON
trade stream, historical trade dumps and label files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions.columns import norm_epoch_ms, norm_ingest_stamp, norm_quote_volume, norm_symbol
from tradewatch.operators.quality import TRADE_JSON_SCHEMA

RAW_PARTITIONS = ("date", "symbol")

AGG_DUMP_SCHEMA = T.StructType([
    T.StructField("agg_trade_id", T.LongType()), T.StructField("price", T.StringType()),
    T.StructField("quantity", T.StringType()), T.StructField("first_trade_id", T.LongType()),
    T.StructField("last_trade_id", T.LongType()), T.StructField("transact_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
])

LABEL_SCHEMA = T.StructType([
    T.StructField("wallet", T.LongType()), T.StructField("label", T.StringType()),
    T.StructField("entity_type", T.StringType()),
])


def read_trades(spark: SparkSession, path: str, start=None, end=None, symbols=None) -> DataFrame:
    """raw_trades (partitioned by date, symbol) for [start, end) and symbols.
    Predicates on the partition columns prune directories; the event-time
    bound is pushed to the Parquet reader as well."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("timestamp") >= F.lit(start).cast("timestamp")))
    if end is not None:
        df = df.where((F.col("date") <= F.lit(end).cast("date")) & (F.col("timestamp") < F.lit(end).cast("timestamp")))
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df


def stream_trades(spark: SparkSession, fmt: str, options: dict, schema: T.StructType = TRADE_JSON_SCHEMA,
                  path: str | None = None, value_col: str = "value", source_schema=None) -> DataFrame:
    """Streaming unified trades from JSON payloads: any source format whose
    rows carry the payload text (text files here; a broker source by
    ``fmt``/``options``, reading from the oldest or latest offset by option)."""
    reader = spark.readStream.format(fmt).options(**options)
    if source_schema is not None:
        reader = reader.schema(source_schema)
    raw = reader.load(path) if path else reader.load()
    if value_col not in raw.columns:
        raw = raw.withColumnRenamed(raw.columns[0], value_col)
    p = raw.select(F.from_json(F.col(value_col).cast("string"), schema).alias("m")).select("m.*")
    for c in ("timestamp", "ingestion_timestamp"):
        p = p.withColumn(c, F.try_to_timestamp(F.regexp_replace(c, "Z$", "")))
    return p


def load_agg_trades(df: DataFrame, symbol: str, exchange: str = "binance", ingested_at=None) -> DataFrame:
    """A historical aggregate-trade dump of one pair (CSV rows of
    AGG_DUMP_SCHEMA) -> the unified schema plus the ``date`` partition column. A time
    that is none gives null (and a null date)."""
    price = F.col("price").try_cast("double")
    qty = F.col("quantity").try_cast("double")
    return df.select(
        F.col("agg_trade_id").cast("string").alias("event_id"), F.lit(exchange).alias("exchange"),
        norm_symbol(F.lit(symbol)).alias("symbol"), price.alias("price"), qty.alias("quantity"),
        norm_quote_volume(price, qty).alias("quote_volume"),
        F.when(F.col("is_buyer_maker"), "sell").otherwise("buy").alias("side"),
        norm_epoch_ms("transact_time").alias("timestamp"), norm_ingest_stamp(ingested_at).alias("ingestion_timestamp"),
    ).withColumn("date", F.to_date("timestamp"))


def read_agg_dump(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=AGG_DUMP_SCHEMA, header=True)


def load_labels(spark: SparkSession, csv_paths=(), json_paths=()) -> DataFrame:
    """Label registry from CSV and JSON files; on a wallet present in several
    sources the later source wins (JSON after CSV, later paths after earlier
    ones)."""
    parts = []
    rank = 0
    for p in csv_paths:
        parts.append(spark.read.csv(p, schema=LABEL_SCHEMA, header=True).withColumn("_rank", F.lit(rank)))
        rank += 1
    for p in json_paths:
        parts.append(spark.read.json(p, schema=LABEL_SCHEMA).withColumn("_rank", F.lit(rank)))
        rank += 1
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    g = u.where(F.col("wallet").isNotNull()).groupBy("wallet").agg(
        F.max_by(F.struct("label", "entity_type"), "_rank").alias("v"))
    return g.select("wallet", "v.label", "v.entity_type")
