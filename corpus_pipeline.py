"""Corpus preparation: quality rules, exact and near deduplication, mixing to
target weights, tokenising. Each stage is written as Parquet and read again as
the next one's documents."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.block_names import exact_groups
from tradewatch.llm.common import keep_rows, numbered, shared_dir, table
from tradewatch.llm.hyperminhash import near_groups
from tradewatch.llm.line_quality import keeps
from tradewatch.llm.mix import mixed
from tradewatch.llm.trie_bpe import encoded


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules reject go; the texts of the others stay whole."""
    return docs.filter(keeps(docs["text"]))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts stays."""
    rows = numbered(docs)
    return keep_rows(rows, exact_groups(rows, rid="__rid").filter("kept").selectExpr("rid AS __rid"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of linked texts stays."""
    rows = numbered(docs)
    return keep_rows(rows, near_groups(rows, rid="__rid").filter("kept").selectExpr("rid AS __rid"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it: not at all, once, twice or three times."""
    rows = numbered(docs)
    copies = mixed(rows, rid="__rid").filter("copies > 0").select(F.col("rid").alias("__rid"), F.col("copies").alias("__copies"))
    rows = rows.join(copies, "__rid")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[rows[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, their count, and the digests of ids and decoded text."""
    return encoded(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mix to target weights", mix_sources),
    ("encode", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/tradewatch-llm/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
