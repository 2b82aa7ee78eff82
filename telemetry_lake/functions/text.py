"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message, lock and webhook formats.
EXFIL_MESSAGE = "DATA EXFILTRATION DETECTED! IP: %s transferred %d bytes in {seconds}s."
LOCK_PREFIX = "alert:throttle:"
PAYLOAD_HEAD = "🚨 **"
PAYLOAD_TAIL = "**"


def utf8(value: Column) -> Column:
    return F.decode(value, "UTF-8")


def exfil_message(src_ip: Column, total_bytes: Column, seconds: int = 60) -> Column:
    return F.format_string(EXFIL_MESSAGE.format(seconds=seconds), src_ip, total_bytes)


def lock_key(src_ip: Column) -> Column:
    return F.concat(F.lit(LOCK_PREFIX), src_ip)


def webhook_payload(message: Column) -> Column:
    """Chat-webhook body; quotes in the message are escaped."""
    content = F.concat(F.lit(PAYLOAD_HEAD), message, F.lit(PAYLOAD_TAIL))
    return F.to_json(F.struct(content.alias("content")))


def json_lines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per row in a single ``value`` column."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))
