"""Alert outbox: the delivery record of every alert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.text import lock_key, webhook_payload


def to_outbox(alerts: DataFrame, status: str = "pending") -> DataFrame:
    """Alerts with their lock key and webhook body; (src_ip, window_end) identifies one."""
    return alerts.select(
        "src_ip",
        "window_end",
        "total_bytes",
        "message",
        lock_key(F.col("src_ip")).alias("lock_key"),
        webhook_payload(F.col("message")).alias("payload"),
        F.lit(status).alias("status"),
    )


def http_delivery(url: str, timeout: float = 5.0) -> Callable[[str], bool]:
    """A ``deliver`` callable that posts the payload and accepts any 2xx answer."""

    def deliver(payload: str) -> bool:
        from urllib.error import URLError
        from urllib.request import Request, urlopen

        request = Request(url, payload.encode("utf-8"), {"Content-Type": "application/json"}, method="POST")
        try:
            with urlopen(request, timeout=timeout) as answer:
                return 200 <= answer.status < 300
        except (URLError, OSError):
            return False

    return deliver
