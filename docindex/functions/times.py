"""Timestamps: parsing, wire form, literals and histogram buckets.

A ``timestamp_ntz`` column is read as UTC wall-clock time.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T

# Text forms accepted besides ISO-8601.
TEXT_FORMATS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
    "dd MMM yyyy HH:mm:ss",
    "MMM dd yyyy HH:mm:ss",
    "MMM dd yyyy",
)

INTERVALS = ("minute", "hour", "day", "week", "month", "quarter", "year")
# Seconds of the units that may be counted, as in ``90m``.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def parse_timestamp(text: Column) -> Column:
    """Instant of a text, to the second; null, empty or unreadable text gives null."""
    text = F.nullif(F.trim(text), F.lit(""))
    digits = text.rlike("^[0-9]+$")
    iso = F.when(~digits, text.try_cast("timestamp"))
    others = [F.try_to_timestamp(text, F.lit(f)) for f in TEXT_FORMATS]
    return F.date_trunc("second", F.coalesce(iso, *others))


def format_timestamp(ts: Column, ntz: bool = False) -> Column:
    """ISO-8601 in UTC, e.g. ``2012-11-30T01:15:23Z``, whatever the session's zone."""
    utc = ts if ntz else F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def instant(value: str | datetime, dtype: T.DataType) -> Column:
    """A literal for comparison with a time column; folds, so it reaches the scan."""
    parsed = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    if parsed.tzinfo is None:
        parsed = parsed.replace(tzinfo=timezone.utc)
    utc = parsed.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(utc).cast("timestamp_ntz")
    return F.lit(utc + "Z").cast("timestamp")


def is_time(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, T.TimestampType | T.TimestampNTZType)


def bucket_start(ts: Column, interval: str, zone: str | None = None) -> Column:
    """Start of the interval that holds ``ts``, as a UTC ``timestamp_ntz``.

    With a zone the interval is a local one (a local day may last 23 or 25
    hours) and its start is reported as an instant.
    """
    counted = re.fullmatch(r"([1-9][0-9]*)([smhdw])", interval)
    if interval not in INTERVALS and not counted:
        raise ValueError(f"interval must be one of {INTERVALS}, or a number and one of {tuple(UNIT_SECONDS)}")

    def start_of(wall: Column) -> Column:
        if not counted:
            return F.date_trunc(interval, wall).cast("timestamp_ntz")
        # Counted from the start of 1970.
        seconds = int(counted[1]) * UNIT_SECONDS[counted[2]]
        since = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), wall.cast("timestamp_ntz"))
        begin = since - F.pmod(since, F.lit(seconds))
        return F.timestamp_add("SECOND", begin, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    if zone is None:
        return start_of(ts)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))
    start = start_of(local)
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), start)
