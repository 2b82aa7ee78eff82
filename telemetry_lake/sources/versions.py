"""Numbered snapshots below a folder: ``<path>/version=<n>``, of which those with a mark of success count."""

from __future__ import annotations

from pyspark.sql import SparkSession

from telemetry_lake.sources.files import found


def latest_version(spark: SparkSession, path: str) -> int | None:
    marks = found(spark, f"{path.rstrip('/')}/version=*/_SUCCESS")
    return max((int(mark.split("/version=")[-1].split("/")[0]) for mark in marks), default=None)
