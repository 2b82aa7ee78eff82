from telemetry_lake.streaming.alerts import alert_sink
from telemetry_lake.streaming.detector import detect, start_detector
from telemetry_lake.streaming.ingest import ingest_bronze, read_checked, start_landing, stored_records
from telemetry_lake.streaming.runner import (
    exact_lateness,
    replay,
    rows_dropped_late,
    run_available,
    run_counting_late_rows,
)
from telemetry_lake.streaming.throttle import throttle_stream

__all__ = [
    "alert_sink",
    "detect",
    "exact_lateness",
    "ingest_bronze",
    "read_checked",
    "replay",
    "rows_dropped_late",
    "run_available",
    "run_counting_late_rows",
    "start_detector",
    "start_landing",
    "stored_records",
    "throttle_stream",
]
