"""Top-k reports. Every order ends in key columns, so ties resolve the same way each run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.schema import DAY_COLUMNS


def top_ip_days(gold: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` (day, source) rows with the most bytes."""
    order = [F.desc("total_bytes_transferred"), *DAY_COLUMNS, "src_ip"]
    return gold.orderBy(*order).limit(n)


def top_talkers(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sources that sent the most bytes in all, from raw, Bronze or Silver rows."""
    totals = df.groupBy("src_ip").agg(F.sum("bytes_sent").alias("total_bytes"))
    return totals.orderBy(F.desc("total_bytes"), "src_ip").limit(n)


def top_per_day(
    daily: DataFrame, n: int = 10, measure: str = "total_bytes_transferred"
) -> DataFrame:
    """The ``n`` leading sources of each day with their ``rank``.

    The rank filter lets Spark cut each day to ``n`` rows per task before the shuffle, so a
    day with very many sources does not gather in one place.
    """
    order = Window.partitionBy(*DAY_COLUMNS).orderBy(F.desc(measure), "src_ip")
    return daily.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
