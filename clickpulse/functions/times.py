"""Time and text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpulse.schema import TS_MAX_MS, TS_MIN_MS

_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def duration_ms(text: str) -> int:
    """Milliseconds of a fixed-length interval such as ``5 seconds``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not match or match.group(2) not in _UNIT_MS:
        raise ValueError(f"not a fixed interval: {text!r}")
    return int(match.group(1)) * _UNIT_MS[match.group(2)]


def in_range(ms: Column) -> Column:
    """The value where it is a representable instant, else null."""
    return F.when(ms.between(TS_MIN_MS, TS_MAX_MS), ms)


def event_time(ms: Column, arrival: Column) -> Column:
    """Event time from epoch milliseconds, falling back to the arrival time."""
    return F.coalesce(F.timestamp_millis(in_range(ms)), arrival)


def utc_day(ms: Column) -> Column:
    """``yyyy-MM-dd`` of epoch milliseconds in UTC, whatever the session time zone is."""
    days = F.floor(in_range(ms) / F.lit(86_400_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def utc_stamp(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch milliseconds in UTC, whatever the session time zone is."""
    second = F.pmod(F.floor(in_range(ms) / 1000), F.lit(86_400)).cast("int")
    parts = (F.floor(second / 3600), F.floor(F.pmod(second, F.lit(3600)) / 60), F.pmod(second, F.lit(60)))
    return F.concat(utc_day(ms), F.lit(" "), F.format_string("%02d:%02d:%02d", *(p.cast("int") for p in parts)))


def bucket(ms: Column, width_ms: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``ms``, 0 for a null. Never null, so a join
    on it adds no null filter that would keep Spark from sharing the two sides' shuffle."""
    return F.coalesce(ms - F.pmod(ms, F.lit(width_ms)), F.lit(0)).cast("bigint")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units; plain ASCII text takes the cheap branch."""
    return F.when(F.octet_length(text) == F.length(text), F.length(text).cast("bigint")).otherwise(
        (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint")
    )
