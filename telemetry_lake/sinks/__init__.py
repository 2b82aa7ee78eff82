from telemetry_lake.sinks.files import upsert_gold, write_gold, write_landing, write_silver
from telemetry_lake.sinks.kafka import publish_json
from telemetry_lake.sinks.outbox import http_delivery, to_outbox

__all__ = [
    "http_delivery",
    "publish_json",
    "to_outbox",
    "upsert_gold",
    "write_gold",
    "write_landing",
    "write_silver",
]
