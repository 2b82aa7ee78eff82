"""Kafka sources. They need the spark-sql-kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.text import utf8

# Fixed value: the topic the telemetry producers write to.
TOPIC = "network-telemetry"
MISSING = "Kafka needs the spark-sql-kafka-0-10 package: start Spark with --packages"


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    min_rows: int | None = None,
    max_delay: str | None = None,
    max_rows: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options. ``min_rows`` with ``max_delay`` starts a micro-batch on whichever comes first."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "minOffsetsPerTrigger": min_rows,
        "maxTriggerDelay": max_delay,
        "maxOffsetsPerTrigger": max_rows,
        **extra,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    streaming: bool = True,
    **options,
) -> DataFrame:
    """Topic values as text. Consumed offsets live in the query's checkpoint.

    Start the detector at ``latest`` and the landing sink at ``earliest``.
    """
    if not streaming and starting == "latest":
        starting = "earliest"
    reader = spark.readStream if streaming else spark.read
    try:
        frame = reader.format("kafka").options(**kafka_options(servers, topic, starting, **options)).load()
    except Exception as error:
        if "kafka" in str(error).lower() and "data source" in str(error).lower():
            raise RuntimeError(MISSING) from error
        raise
    return frame.select(utf8(F.col("value")).alias("value"))
