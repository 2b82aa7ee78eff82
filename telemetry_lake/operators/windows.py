"""Event-time windows per source address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.text import exfil_message
from telemetry_lake.functions.time import seconds_of
from telemetry_lake.schema import EXFIL_WINDOW_BYTES, LATENESS, WINDOW_SIZE, WINDOW_SLIDE


def assign_event_time(df: DataFrame, ts: str = "ts", lateness: str | None = LATENESS) -> DataFrame:
    """Rows that have an event time; a stream also gets its watermark."""
    timed = df.filter(F.col(ts).isNotNull())
    return timed.withWatermark(ts, lateness) if df.isStreaming and lateness else timed


def sliding_bandwidth(
    df: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str | None = LATENESS,
    panes: bool | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Bytes, packets and mean rate per source and sliding window ``[start, end)``.

    A batch first sums non-overlapping panes as long as the slide and then adds up the panes
    of each window, so a row is expanded into its windows only after aggregation. A stream
    (or ``panes=False``) assigns rows to windows directly.
    """
    rows = assign_event_time(df, ts, watermark).filter(F.col("src_ip").isNotNull())
    width, step = seconds_of(size), seconds_of(slide)
    if panes is None:
        panes = not df.isStreaming and width > step
    if panes and (df.isStreaming or width % step):
        raise ValueError("panes need a batch and a size that is a multiple of the slide")
    totals = _from_panes(rows, width, step, ts) if panes else _direct(rows, width, step, ts)
    return totals.withColumn("avg_bytes_per_sec", F.col("total_bytes") / F.lit(width))


def _sums() -> list[Column]:
    return [
        F.coalesce(F.sum("bytes_sent"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.count("*").alias("packet_count"),
    ]


def _direct(rows: DataFrame, width: int, step: int, ts: str) -> DataFrame:
    frame = F.window(ts, f"{width} seconds", f"{step} seconds")
    return rows.groupBy("src_ip", frame.alias("w")).agg(*_sums()).select(
        "src_ip",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_bytes",
        "packet_count",
    )


def _from_panes(rows: DataFrame, width: int, step: int, ts: str) -> DataFrame:
    pane = F.window(ts, f"{step} seconds").getField("start")
    partial = rows.groupBy("src_ip", pane.alias("pane")).agg(*_sums())
    first = F.col("pane") - F.expr(f"INTERVAL {width - step} SECOND")
    starts = F.sequence(first, F.col("pane"), F.expr(f"INTERVAL {step} SECOND"))
    spread = partial.select("src_ip", F.explode(starts).alias("window_start"), "total_bytes", "packet_count")
    return spread.groupBy("src_ip", "window_start").agg(
        F.sum("total_bytes").alias("total_bytes"), F.sum("packet_count").alias("packet_count")
    ).select(
        "src_ip",
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {width} SECOND")).alias("window_end"),
        "total_bytes",
        "packet_count",
    )


def exfil_alerts(
    df: DataFrame,
    threshold: int = EXFIL_WINDOW_BYTES,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str | None = LATENESS,
    panes: bool | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Windows whose byte sum exceeds ``threshold``, with the alert text."""
    totals = sliding_bandwidth(df, size, slide, watermark, panes, ts)
    message = exfil_message(F.col("src_ip"), F.col("total_bytes"), seconds_of(size))
    return totals.filter(F.col("total_bytes") > threshold).withColumn("message", message)


def events_per_second(
    df: DataFrame, width: str = "1 second", watermark: str | None = LATENESS, ts: str = "ts"
) -> DataFrame:
    """Event count per tumbling window, on a batch or a stream."""
    rows = assign_event_time(df, ts, watermark)
    counts = rows.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("events"))
    return counts.select(F.col("w.start").alias("second"), "events")
