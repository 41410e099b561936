"""Folder operations on any Hadoop file system (hdfs, s3a, gs, file)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below a folder, sorted."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))
