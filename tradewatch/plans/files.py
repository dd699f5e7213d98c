"""Folders of partitioned tables: names of partitions, and removal of what is superseded
or expired. Paths are resolved by the cluster's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's outermost partition column, sorted; one listing of one folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(column + "="))


def remove(spark: SparkSession, *paths: str) -> None:
    """Remove files or folders that no reader needs any more; what is gone already is fine."""
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def signature(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and change time of a table's files: differs as soon as its data does."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    status = fs.getFileStatus(p)
    found = fs.listStatus(p) if status.isDirectory() else [status]
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)
