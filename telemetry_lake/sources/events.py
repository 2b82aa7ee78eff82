"""The ``events`` table seen as network telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemetry_lake.functions.time import iso_utc


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, schema: StructType) -> DataFrame:
    # The character class makes this a glob, which a file source takes for a file and a folder alike.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def as_telemetry(events: DataFrame) -> DataFrame:
    """Event rows as telemetry records, with ``ts`` as the parsed event time."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind, value = F.col("event_type"), F.col("value")
    exfil = (kind == "purchase") & (value >= 100)
    failed = kind == "error"
    scan = kind == "view"
    ts = F.col("ts").cast("timestamp")
    flags = (
        F.when(failed, F.array(F.lit("RST"), F.lit("ACK")))
        .when(scan, F.array(F.lit("SYN")))
        .otherwise(F.array(F.lit("ACK"), F.lit("PSH")))
    )
    return events.select(
        iso_utc(ts).alias("timestamp"),
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(
            F.lit("10.0."), F.expr("user_id div 256").cast("string"),
            F.lit("."), (F.col("user_id") % 256).cast("string"),
        ).alias("src_ip"),
        F.concat(F.lit("172.16.0."), (F.col("event_id") % 20).cast("string")).alias("dst_ip"),
        (F.lit(1024) + k).alias("src_port"),
        F.when(exfil, 53).when(scan, 20 + k).otherwise(443).alias("dst_port"),
        F.when(exfil, "UDP").otherwise("TCP").alias("protocol"),
        (F.round(value * 100).cast("bigint") * 1000).alias("bytes_sent"),
        (k.cast("bigint") * 100).alias("bytes_received"),
        F.when(failed, 2000 + 50 * k).otherwise(10 + k % 40).alias("latency_ms"),
        (k + 5).alias("packets_sent"),
        flags.alias("flags"),
        F.struct(
            F.lit("HTTP/1.1").alias("protocol"),
            F.lit("GET").alias("method"),
            kind.alias("host"),
            F.when(failed, 503).otherwise(200).alias("status_code"),
        ).alias("app_layer"),
        F.struct(
            F.lit("prod").alias("env"),
            F.lit("us-east-1").alias("region"),
            F.lit("").alias("security_group"),
        ).alias("tags"),
        ts.alias("ts"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telemetry(read_events(spark, sf_dir))
