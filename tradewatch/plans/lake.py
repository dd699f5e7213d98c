"""Batch and lakehouse operations on plain Parquet: snapshots
are commit-tagged rows (R22), schema and partition evolution use the catalog
or a union of layouts, and retention is a partition filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.plans.modules import run_modules
from tradewatch.operators.alerts import alert_union
from tradewatch.plans.sinks import read_if_exists


def snapshot_write(df: DataFrame, path: str, commit_id: int, committed_at: str, partition_cols=("date",)) -> None:
    """Append one commit: rows carry commit_id and committed_at."""
    out = df.withColumn("commit_id", F.lit(commit_id).cast("long")) \
            .withColumn("committed_at", F.lit(committed_at).cast("timestamp"))
    out.write.mode("append").partitionBy(*partition_cols).parquet(path)


def snapshot_read(spark: SparkSession, path: str, version: int | None = None, timestamp=None) -> DataFrame:
    """The table as of a commit id or a commit time."""
    df = spark.read.parquet(path)
    if version is not None:
        df = df.where(F.col("commit_id") <= F.lit(version))
    if timestamp is not None:
        df = df.where(F.col("committed_at") <= F.lit(timestamp).cast("timestamp"))
    return df


def reprocess(snapshot: DataFrame, cfg: dict, modules=("MOD-001", "MOD-002", "MOD-003"),
              processed_at: str | None = None) -> DataFrame:
    """Current modules over an old snapshot: the ``*_reprocessed`` alert set."""
    return alert_union(*run_modules(snapshot, cfg, modules, processed_at).values())


def reconcile(old: DataFrame, new: DataFrame, key: str = "alert_id", compare=None) -> DataFrame:
    """Full outer join on the key: status same / changed / missing (only in
    old) / new (only in new), and the names of the changed columns (null-safe
    equality per column)."""
    cols = list(compare or [c for c in old.columns if c != key and c in new.columns])
    o = old.select(key, *[F.col(c).alias("o_" + c) for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(key, *[F.col(c).alias("n_" + c) for c in cols], F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full")
    diffs = F.array_compact(F.array(*[F.when(~F.col("o_" + c).eqNullSafe(F.col("n_" + c)), F.lit(c)) for c in cols]))
    status = (F.when(F.col("_in_new").isNull(), "missing").when(F.col("_in_old").isNull(), "new")
              .when(F.size(diffs) > 0, "changed").otherwise("same"))
    both = F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull()
    return j.select(key, status.alias("status"),
                    F.when(both, F.array_join(diffs, ",")).otherwise(F.lit("")).alias("changed_columns"))


def swap_if_valid(spark: SparkSession, pointers: str, name: str, new_path: str, diff: DataFrame,
                  max_share: float = 0.01) -> DataFrame:
    """Point the table ``name`` at the reprocessed folder only if at most
    ``max_share`` of the compared rows differ (changed, missing or new). The pointer is a
    row appended to the table ``pointers``, which outlives the session; the last one counts."""
    summary = diff.agg(
        F.count(F.when(F.col("status") != "same", 1)).alias("differing"),
        F.count(F.lit(1)).alias("compared")).withColumn("passed", F.col("differing") <= F.col("compared") * F.lit(max_share))
    row = summary.first()
    if row["passed"]:
        spark.range(1).select(F.lit(name).alias("name"), F.lit(new_path).alias("path"),
                              F.current_timestamp().alias("swapped_at")).write.mode("append").parquet(pointers)
    return spark.createDataFrame([(name, row["differing"], row["compared"], row["passed"])],
                                 "name string, differing long, compared long, passed boolean")


def current_table(spark: SparkSession, pointers: str, name: str) -> DataFrame | None:
    """The folder that ``name`` points at, or None before the first swap."""
    p = read_if_exists(spark, pointers)
    row = None if p is None else p.where(F.col("name") == name).orderBy(F.desc("swapped_at")).first()
    return None if row is None else spark.read.parquet(row["path"])


def evolve_add_column(spark: SparkSession, table: str, name: str, dtype: str) -> None:
    """Add a column to a catalog table; existing files read it as NULL."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {dtype})")


def evolve_partition(spark: SparkSession, old_path: str, new_path: str) -> DataFrame:
    """Daily layout (old data) and hourly layout (new data) as one table."""
    old = spark.read.parquet(old_path)
    new = spark.read.parquet(new_path)
    return old.unionByName(new, allowMissingColumns=True)


def table_ddl(schema: T.StructType, name: str, partition_cols=(), fmt: str = "parquet",
              location: str | None = None) -> str:
    """CREATE TABLE text from a StructType and a partition spec."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING {fmt}"
    if partition_cols:
        ddl += f"\nPARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        ddl += f"\nLOCATION '{location}'"
    return ddl


def table_stats(spark: SparkSession, table: str) -> DataFrame:
    """Recover the partitions of a catalog table, refresh its statistics and return
    them: a row per data column with the table's rows and the column's nulls, minimum and maximum
    (as text). Only catalog metadata passes through the driver."""
    fields = spark.catalog.listColumns(table)
    if any(f.isPartition for f in fields):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    names = [f.name for f in fields if not f.isPartition]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{n}`' for n in names)}")
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Statistics").first()["data_type"]
    rows = int(text.split(",")[1].split()[0])
    out = []
    for n in names:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{n}`").collect()}
        known = {k: None if info.get(k) in (None, "NULL") else info[k] for k in ("num_nulls", "min", "max")}
        out.append((n, rows, None if known["num_nulls"] is None else int(known["num_nulls"]), known["min"], known["max"]))
    return spark.createDataFrame(out, "column_name string, row_count long, null_count long, min_value string, max_value string")


def retention(df: DataFrame, col: str, as_of, days: float) -> DataFrame:
    """Rows newer than ``as_of - days``; the day partition ``dt``, where there is one, prunes."""
    ref = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    lo = F.timestamp_micros(F.unix_micros(ref) - F.lit(int(days * 86400 * 1_000_000)))
    if "dt" in df.columns:
        df = df.where(F.col("dt").cast("date") >= F.to_date(lo))
    return df.where(F.col(col).cast("timestamp") > lo)


def governed_view(df: DataFrame, role: str, restricted: dict) -> DataFrame:
    """Projection without the columns restricted for ``role``."""
    return df.drop(*restricted.get(role, []))
