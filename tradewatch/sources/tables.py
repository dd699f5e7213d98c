"""Driver tables as DataFrames (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the scan's own splits set the parallelism
    (``spark.sql.files.maxPartitionBytes`` and the files' row groups)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
