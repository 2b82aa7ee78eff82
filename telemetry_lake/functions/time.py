"""Event-time expressions."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# An epoch beyond this many seconds is read as milliseconds.
MILLIS_ABOVE = 20_000_000_000

_EPOCH = r"^[+-]?[0-9]+([.][0-9]+)?$"
_DATED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"
_ISO_UTC = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{6})?Z$"
_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def seconds_of(duration: str | int | timedelta) -> int:
    """Whole seconds of ``"10 minutes"``, a timedelta or a plain number."""
    if isinstance(duration, timedelta):
        return int(duration.total_seconds())
    if isinstance(duration, int):
        return duration
    parts = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration)
    if not parts or parts.group(2) not in _UNITS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(parts.group(1)) * _UNITS[parts.group(2)]


def epoch_timestamp(value: Column) -> Column:
    """Numeric text, seconds or milliseconds since 1970, as TIMESTAMP; NULL when out of range."""
    number = value.try_cast("decimal(20,6)")
    micros = F.when(F.abs(number) > MILLIS_ABOVE, number * 1_000).otherwise(number * 1_000_000)
    return F.timestamp_micros(micros.try_cast("bigint"))


def event_timestamp(value: Column) -> Column:
    """TIMESTAMP of either wire form: epoch number or ISO-8601 text; NULL when it is neither.

    A bare time of day is neither: it would become a moment of the day on which the job runs.
    """
    text = value.cast("string")
    dated = F.when(F.trim(text).rlike(_DATED), F.try_to_timestamp(text))
    return F.when(text.rlike(_EPOCH), epoch_timestamp(text)).otherwise(dated)


def is_event_timestamp(value: Column, parsed: Column) -> Column:
    """Whether text is a complete date, date-time or epoch number (a bare time of day is not).

    ``parsed`` is its ``event_timestamp``.
    """
    return parsed.isNotNull() & (value.rlike(_EPOCH) | value.rlike(_DATED))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC; fractional digits appear only when there are any."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    fraction = F.unix_micros(ts) % 1_000_000 != 0
    return F.when(fraction, F.date_format(ts, pattern + ".SSSSSS'Z'")).otherwise(
        F.date_format(ts, pattern + "'Z'")
    )


def normal_stamp(value: Column, parsed: Column) -> Column:
    """Time text in the ``iso_utc`` form; text that already has it is passed on."""
    return F.when(value.rlike(_ISO_UTC), value).otherwise(iso_utc(parsed))


def date_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def shift(ts: Column, duration: str | int | timedelta, back: bool = False) -> Column:
    """``ts`` moved forward, or ``back``, by a duration."""
    step = F.make_dt_interval(secs=F.lit(seconds_of(duration)).cast("decimal(18,6)"))
    return ts - step if back else ts + step
