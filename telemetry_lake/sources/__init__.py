from telemetry_lake.sources.events import as_telemetry, read_events, stream_events, telemetry
from telemetry_lake.sources.kafka import kafka_options, read_kafka
from telemetry_lake.sources.landing import (
    between_days,
    read_bronze,
    read_gold,
    read_raw,
    read_silver,
    with_source_file,
)
from telemetry_lake.sources.tables import (
    overwrite_table,
    read_table,
    upsert_table,
)

__all__ = [
    "as_telemetry",
    "between_days",
    "kafka_options",
    "overwrite_table",
    "read_bronze",
    "read_events",
    "read_gold",
    "read_kafka",
    "read_raw",
    "read_silver",
    "read_table",
    "stream_events",
    "telemetry",
    "upsert_table",
    "with_source_file",
]
