"""Folder look-ups through Hadoop's file system API, so any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(full path, is a folder, bytes) of each entry; nothing for a missing folder."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(
        (s.getPath().toString(), s.isDirectory(), s.getLen()) for s in fs.listStatus(handle)
    )


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        fs, handle = _open(spark, path)
        total += fs.getContentSummary(handle).getLength()
    return total


def rename(spark: SparkSession, path: str, new: str) -> None:
    fs, handle = _open(spark, path)
    if not fs.rename(handle, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {path}")
