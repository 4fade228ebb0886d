"""Time expressions. Instants leave the operators as BIGINT epoch milliseconds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds per unit.
UNIT_MS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
}


def duration_ms(text: str | int) -> int:
    """``'10 seconds'`` → 10000; a number is taken as milliseconds."""
    if isinstance(text, int):
        return text
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not match or match.group(2) not in UNIT_MS:
        raise ValueError(f"not a duration: {text!r}")
    return int(match.group(1)) * UNIT_MS[match.group(2)]


def epoch_ms(timestamp: Column) -> Column:
    """Epoch milliseconds of a timestamp; zone-less values count as UTC
    (``weir.session.configure`` pins the session zone)."""
    return F.unix_millis(timestamp.cast("timestamp"))


def as_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def window_start_ms(ms: Column, size_ms: int) -> Column:
    """Start of the tumbling window holding ``ms``."""
    return ms - F.pmod(ms, F.lit(size_ms))


def next_boundary_ms(ms: Column, size_ms: int) -> Column:
    """First multiple of ``size_ms`` strictly after ``ms``."""
    return window_start_ms(ms, size_ms) + F.lit(size_ms)


def minute_label(ms: Column) -> Column:
    return F.date_format(as_timestamp(ms), "yyyyMMdd-HHmm")
