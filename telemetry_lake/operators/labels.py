"""Anomaly labels per record and the reports built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.operators.windows import assign_event_time
from telemetry_lake.schema import (
    EXFIL_PORT,
    EXFIL_PROTOCOL,
    EXFIL_RECORD_BYTES,
    LATENCY_SPIKE_MS,
    LATENESS,
    RESET_FLAG,
    RESET_STATUS,
    SCAN_FLAG,
    SCAN_PORTS,
)

LABELS = ("latency_spike", "exfiltration", "connection_reset")


def _true(condition: Column) -> Column:
    """A predicate on incomplete records: unknown counts as not matched."""
    return F.coalesce(condition, F.lit(False))


def is_latency_spike() -> Column:
    return _true(F.col("latency_ms") >= LATENCY_SPIKE_MS)


def is_exfiltration() -> Column:
    return _true(
        (F.col("bytes_sent") >= EXFIL_RECORD_BYTES)
        & (F.col("dst_port") == EXFIL_PORT)
        & (F.col("protocol") == EXFIL_PROTOCOL)
    )


def is_connection_reset() -> Column:
    reset = _true(F.array_contains("flags", RESET_FLAG))
    return reset | _true(F.col("app_layer.status_code") >= RESET_STATUS)


def label_anomalies(df: DataFrame) -> DataFrame:
    """One boolean per label and their names in ``labels``; a record may carry several."""
    tests = dict(zip(LABELS, (is_latency_spike(), is_exfiltration(), is_connection_reset()), strict=True))
    flagged = df.withColumns(tests)
    names = F.array_compact(F.array(*[F.when(F.col(name), F.lit(name)) for name in LABELS]))
    return flagged.withColumn("labels", names)


def anomaly_rates(
    df: DataFrame, window: str = "1 minute", watermark: str | None = LATENESS, ts: str = "ts"
) -> DataFrame:
    """Share of records carrying each label, per tumbling window."""
    rows = label_anomalies(assign_event_time(df, ts, watermark))
    shares = [F.avg(F.col(name).cast("int")).alias(f"{name}_rate") for name in LABELS]
    rates = rows.groupBy(F.window(ts, window).alias("w")).agg(F.count("*").alias("events"), *shares)
    return rates.select(F.col("w.start").alias("window_start"), "events", *[f"{n}_rate" for n in LABELS])


def port_scans(
    df: DataFrame,
    window: str = "1 minute",
    min_ports: int = SCAN_PORTS,
    watermark: str | None = LATENESS,
    ts: str = "ts",
) -> DataFrame:
    """Source-target pairs that probe ``min_ports`` or more ports with bare SYN packets.

    Counted in two steps: packets per port, then ports per pair. The first step spreads one
    busy pair over its ports, keeps only counters as streaming state and works on batches and
    streams alike.
    """
    bare_syn = (F.size("flags") == 1) & F.array_contains("flags", SCAN_FLAG) & F.col("dst_port").isNotNull()
    # Naming the time in the condition keeps it behind the watermark, which all traffic moves on.
    probes = assign_event_time(df, ts, watermark).filter(F.when(F.col(ts).isNotNull(), bare_syn))
    frame = F.window(ts, window).alias("w")
    per_port = probes.groupBy("src_ip", "dst_ip", frame, "dst_port").agg(F.count("*").alias("n"))
    per_pair = per_port.groupBy("src_ip", "dst_ip", "w").agg(
        F.count("*").alias("distinct_ports"), F.sum("n").alias("packets")
    )
    return per_pair.filter(F.col("distinct_ports") >= min_ports).select(
        "src_ip",
        "dst_ip",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "distinct_ports",
        "packets",
    )


def anomalous_daily(silver: DataFrame) -> DataFrame:
    """Bytes and labelled records per day and source, from rows that carry the label columns."""
    labelled = label_anomalies(silver).filter(F.size("labels") > 0)
    return labelled.groupBy("year", "month", "day", "src_ip").agg(
        F.count("*").alias("anomalies"), F.sum("bytes_sent").alias("anomalous_bytes")
    )
