"""Query registry: each SURVEY 2 id maps to a Spark callable (spark, sf_dir)
and, where SQL can state it, a DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewatch.session import prepare
from tradewatch.suite.oracle import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed processing clock for lineage in compared results (R20).
PROCESSED_AT = "2024-02-01T00:00:00.000Z"


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def sql(name: str, text: str) -> None:
    SQL[name] = text
