"""Folders of a table by pattern, through the file system the session reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    path, system = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [])


def mark(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.mkdirs(path)


def remove(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)
