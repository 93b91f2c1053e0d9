"""Event-time expressions; window bounds are microseconds since the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def window_start(ts_us: Column, size_us: int) -> Column:
    """Start of the epoch-aligned window ``[start, start + size)`` that holds the time."""
    return ts_us - F.pmod(ts_us, F.lit(size_us))


def event_time(attribute: Column) -> Column:
    """Event time out of a text attribute: ISO date-time or milliseconds since the epoch."""
    return F.coalesce(F.timestamp_millis(attribute.try_cast("bigint")), attribute.try_cast("timestamp"))
