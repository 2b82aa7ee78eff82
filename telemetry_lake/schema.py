"""Record, table and threshold definitions shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the wire record.
APP_LAYER = T.StructType(
    [
        T.StructField("protocol", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
    ]
)

TAGS = T.StructType(
    [
        T.StructField("env", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("security_group", T.StringType()),
    ]
)

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("bytes_sent", T.LongType()),
        T.StructField("bytes_received", T.LongType()),
        T.StructField("latency_ms", T.IntegerType()),
        T.StructField("packets_sent", T.IntegerType()),
        T.StructField("flags", T.ArrayType(T.StringType())),
        T.StructField("app_layer", APP_LAYER),
        T.StructField("tags", TAGS),
    ]
)

# The columns each refined layer carries.
SILVER_COLUMNS = ["timestamp", "event_id", "src_ip", "dst_ip", "bytes_sent", "latency_ms"]
DAY_COLUMNS = ["year", "month", "day"]
GOLD_KEYS = [*DAY_COLUMNS, "src_ip"]

# Detector settings and label boundaries.
EXFIL_WINDOW_BYTES = 50_000_000
WINDOW_SIZE = "60 seconds"
WINDOW_SLIDE = "10 seconds"
LATENESS = "5 seconds"
THROTTLE_SECONDS = 900
LATENCY_SPIKE_MS = 2_000
EXFIL_RECORD_BYTES = 10_000_000
EXFIL_PORT = 53
EXFIL_PROTOCOL = "UDP"
RESET_FLAG = "RST"
RESET_STATUS = 500
SCAN_FLAG = "SYN"
SCAN_PORTS = 100

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"

# What a JSON landing file is read with: malformed lines keep their text.
LANDING = T.StructType([*TELEMETRY.fields, T.StructField(CORRUPT, T.StringType())])
BRONZE = T.StructType([*LANDING.fields, T.StructField(SOURCE_FILE, T.StringType())])
