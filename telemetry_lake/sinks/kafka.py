"""Kafka sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry_lake.functions.text import json_lines
from telemetry_lake.sources.kafka import MISSING, TOPIC


def publish_json(df: DataFrame, servers: str, topic: str = TOPIC, checkpoint: str | None = None, **options):
    """Each row as one JSON value, to any partition. A stream returns its running query."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    rows = json_lines(df)
    try:
        if df.isStreaming:
            if checkpoint is None:
                raise ValueError("publishing a stream needs a checkpoint folder")
            return rows.writeStream.format("kafka").options(**settings).option("checkpointLocation", checkpoint).start()
        rows.write.format("kafka").options(**settings).save()
    except Exception as error:
        if "data source" in str(error).lower() and "kafka" in str(error).lower():
            raise RuntimeError(MISSING) from error
        raise
    return None
