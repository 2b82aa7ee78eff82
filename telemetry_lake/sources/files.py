"""Folders as the session's file system sees them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in matches or []]


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote the folder has committed."""
    return bool(found(spark, f"{folder}/_SUCCESS"))
