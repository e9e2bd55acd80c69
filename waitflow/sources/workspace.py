"""Folders of a session's warehouse, for tables that a run writes and reads again."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.sql.warehouse.dir, which driver and executors share. It goes when the JVM ends."""
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-{uuid4().hex}"
    files, target = _file_system(spark, path)
    files.mkdirs(target)
    keep_until_exit(spark, path)
    return path


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """Has an existing folder deleted when the session's JVM ends."""
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; nothing happens where there is none."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)
