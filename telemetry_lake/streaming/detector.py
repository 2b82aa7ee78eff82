"""The exfiltration detector as one streaming query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.operators.validate import parse_events
from telemetry_lake.operators.windows import exfil_alerts
from telemetry_lake.streaming.runner import exact_lateness


def detect(values: DataFrame, value_col: str = "value", **window) -> DataFrame:
    """Alerts from a stream of JSON text: parse, watermark, sliding sum, threshold, message."""
    events, _ = parse_events(values, value_col)
    return exfil_alerts(events, **window)


def start_detector(
    alerts: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = "1 second",
    exact: bool = True,
) -> StreamingQuery:
    """Feed closed alert windows to ``handle``. ``exact`` needs a single stateful operator."""
    writer = alerts.writeStream.outputMode("append").foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if not exact:
        return writer.start()
    with exact_lateness(alerts.sparkSession):
        return writer.start()
