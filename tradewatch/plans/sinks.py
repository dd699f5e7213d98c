"""Sinks: partitioned appends, keyed upsert without a table
format, the dead-letter table and alert routing.

Without a transactional table format the upsert is idempotent, not atomic:
re-running a batch writes nothing new because every key already present in
its partition is dropped by the anti join. The alert id fixes the day
partition (detected_at is event time), so a repeat is always found there."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tradewatch.session import ensure_checkpoint_dir

ALERT_PARTITIONS = ("dt", "alert_type")


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The folder as a DataFrame, or None when it does not exist yet or holds no data
    file. Any other failure is the caller's: a table that can't be read is not empty."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def with_day(df: DataFrame, ts_col: str, name: str = "dt") -> DataFrame:
    return df.withColumn(name, F.date_format(ts_col, "yyyy-MM-dd"))


def sink_partitioned(df: DataFrame, path: str, cols=ALERT_PARTITIONS, ts_col: str = "detected_at",
                     mode: str = "append") -> None:
    """Append (or overwrite only the touched partitions) by partition columns;
    a ``dt`` day column is derived from ``ts_col`` when asked for."""
    if "dt" in cols and "dt" not in df.columns:
        df = with_day(df, ts_col)
    w = df.write.mode(mode).partitionBy(*cols)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def sink_upsert(df: DataFrame, path: str, key: str = "alert_id", cols=ALERT_PARTITIONS,
                ts_col: str = "detected_at") -> None:
    """Conditional put: a key is written at most once. The batch is
    deduplicated on the key, then anti-joined with the existing rows of the
    partitions the batch touches (partition-pruned read), then appended.
    The batch is read twice (touched partitions, rows to write), so it is
    first checkpointed to the shared checkpoint folder: both reads then see
    the same rows even for a nondeterministic input or after a lost executor."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if "dt" in cols and "dt" not in df.columns:
        df = with_day(df, ts_col)
    batch = df.dropDuplicates([key]).checkpoint(eager=True)
    existing = read_if_exists(spark, path)
    if existing is not None:
        # the partitions the batch touches, as literals: at most days x alert types of one batch
        for c in cols:
            values = [r[0] for r in batch.select(F.col(c).cast("string")).distinct().collect()]
            existing = existing.where(F.col(c).cast("string").isin(values))
        existing = existing.select(*[F.col(c).cast("string").alias(c) for c in cols], key)
        batch = batch.join(existing, [*cols, key], "left_anti")
    batch.write.mode("append").partitionBy(*cols).parquet(path)


def _write_batch(df: DataFrame, path: str, cols, batch_id: int | None) -> None:
    """Append; with a batch id, a replay overwrites the partitions of that id."""
    if batch_id is None:
        df.write.mode("append").partitionBy(*cols).parquet(path)
        return
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*cols, "batch_id").parquet(path))


def sink_dlq(invalid: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Failed rows under reason=/dt= folders (and batch_id= in a stream)."""
    _write_batch(invalid, path, ("reason", "dt"), batch_id)


def route_alerts(alerts: DataFrame, hot_path: str, cold_path: str, batch_id: int | None = None) -> None:
    """One alert set to the hot keyed store (upsert, read with an expiry
    filter) and the cold partitioned table; the batch is persisted so both
    writes reuse one computation. A stream passes its batch id, so that a replayed
    batch changes neither store."""
    a = with_day(alerts, "detected_at").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink_upsert(a, hot_path)
        _write_batch(a, cold_path, ALERT_PARTITIONS, batch_id)
    finally:
        a.unpersist()
