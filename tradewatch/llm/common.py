"""Shared helpers of the corpus operators: input tables, saved intermediates
in the cluster's shared folder, ASCII normalisation and row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word is a run of characters other than the space and the controls 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session may leave the
    setting unset; it then gets a folder of its own."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradewatch-llm-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back. Cuts the
    lineage, survives lost executors, and gives the planner real sizes. Texts take half the
    space of the default codec."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/tradewatch-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. A text of one-byte characters takes the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def with_rid(docs: DataFrame, name: str = "__rid") -> DataFrame:
    """Number the rows; rows that repeat, or share an id, stay apart. The number depends
    on the file splits, which change with the cores registered when a scan is planned, so
    it holds for this one scan. Where rows are joined by it, use ``numbered``."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def numbered(docs: DataFrame, name: str = "__rid") -> DataFrame:
    """The rows with their number, written once: every later read gives the same one."""
    return saved(with_rid(docs, name), "numbered-rows")


def source_rows(docs: DataFrame, rid: str | None, **columns: str) -> DataFrame:
    """rid and the columns asked for, as a stored table. ``rid`` names the column of a
    ``numbered`` table that has the number; without it the rows are numbered here."""
    chosen = [F.col(c).alias(name) for name, c in columns.items()]
    if rid is None:
        return numbered(docs.select(*chosen), "rid").select("rid", *columns)
    return docs.select(F.col(rid).alias("rid"), *chosen)


def keep_rows(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of a ``numbered`` table whose number is in ``decided`` (one column,
    ``__rid``), without the number."""
    return rows.join(decided, "__rid", "left_semi").drop("__rid")
