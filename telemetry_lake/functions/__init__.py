from telemetry_lake.functions.frames import evaluated
from telemetry_lake.functions.text import exfil_message, json_lines, lock_key, utf8, webhook_payload
from telemetry_lake.functions.time import (
    date_parts,
    epoch_millis,
    epoch_timestamp,
    event_timestamp,
    iso_utc,
    seconds_of,
    shift,
)

__all__ = [
    "date_parts",
    "epoch_millis",
    "epoch_timestamp",
    "evaluated",
    "event_timestamp",
    "exfil_message",
    "iso_utc",
    "json_lines",
    "lock_key",
    "seconds_of",
    "shift",
    "utf8",
    "webhook_payload",
]
