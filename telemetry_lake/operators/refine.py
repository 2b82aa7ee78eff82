"""Bronze to Silver to Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.time import date_parts, event_timestamp
from telemetry_lake.schema import GOLD_KEYS, SILVER_COLUMNS


def to_silver(
    df: DataFrame,
    dedupe: bool = False,
    columns: list[str] = SILVER_COLUMNS,
    watermark: str | None = None,
) -> DataFrame:
    """Rows with a source and a byte count, plus parsed time and its date parts.

    A timestamp that cannot be parsed stays, with NULL time and date parts. ``dedupe`` keeps
    one row per event id (rows without an id are kept); on a stream it looks back ``watermark``.
    """
    rows = df.filter(F.col("src_ip").isNotNull() & F.col("bytes_sent").isNotNull()).select(*columns)
    rows = rows.withColumn("parsed_timestamp", event_timestamp(F.col("timestamp")))
    if dedupe:
        rows = unique_events(rows, watermark)
    return rows.withColumns(date_parts(F.col("parsed_timestamp")))


def unique_events(
    df: DataFrame, watermark: str | None = None, key: str = "event_id", ts: str = "parsed_timestamp"
) -> DataFrame:
    """One row per event id; the earliest copy by time, then by content, wins.

    Copies collapse on the map side before the shuffle, so a record repeated a billion times
    costs one row per task.
    """
    if df.isStreaming:
        if watermark is None:
            raise ValueError("de-duplicating a stream needs a watermark delay")
        # Rows without an id or a time cannot be compared with others and pass by.
        rows, comparable = df.withWatermark(ts, watermark), F.col(key).isNotNull() & F.col(ts).isNotNull()
        return rows.filter(comparable).dropDuplicatesWithinWatermark([key]).unionByName(rows.filter(~comparable))
    # Rows without an id get a number of their own and so stay apart, in the same scan.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("_alone")
    rest = [c for c in df.columns if c not in (key, ts)]
    first = F.min(F.struct(ts, *rest)).alias("_first")
    return df.withColumn("_alone", alone).groupBy(key, "_alone").agg(first).select(key, "_first.*").select(*df.columns)


def to_gold(silver: DataFrame) -> DataFrame:
    """Bytes and connections per day and source. Rows without an event id are not counted."""
    return silver.groupBy(*GOLD_KEYS).agg(
        F.sum("bytes_sent").alias("total_bytes_transferred"),
        F.count("event_id").alias("total_connections"),
    )
