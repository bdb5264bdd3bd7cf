"""Folder operations that Spark's readers and writers do not offer: listing and deleting.

The only place that goes through the JVM gateway (Hadoop's FileSystem, so any store that Spark
reads). Under Spark Connect there is no gateway: housekeeping (emptied months of a plain table, vacuum, log
compaction) then has to run from a classic session; computing, publishing and reading do not need it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what matches a glob pattern, one level of names."""
    p, fs = _at(spark, pattern)
    found = fs.globStatus(p)
    return [(str(s.getPath()), s.getModificationTime()) for s in found or []]


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds; a missing one is no error."""
    p, fs = _at(spark, path)
    fs.delete(p, True)
