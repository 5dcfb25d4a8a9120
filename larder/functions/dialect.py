"""Rounding, null and time rules that differ from Spark's own functions.

Helpers for wide projections take and return SQL text; the score's arithmetic uses columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Integers of the change logs are wide decimals: casting rounds halves away from zero.
NUM38 = "decimal(38,0)"
MONEY = "decimal(38,2)"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def add_days(date: Column, days: Column) -> Column:
    """Date plus a rounded number of days (halves away from zero); stays a DATE."""
    return F.date_add(date, F.round(days).cast("int"))


def safe_divide(numerator: str, denominator: str) -> str:
    """Division that yields NULL for a zero divisor instead of an ANSI error."""
    return f"({numerator} / nullif({denominator}, 0))"


def ntz_from_millis(millis: str) -> str:
    """Epoch milliseconds as a zone-less timestamp, whatever the session zone is."""
    return f"timestampadd(MILLISECOND, CAST({millis} AS BIGINT), {EPOCH})"


def ntz_from_seconds(seconds: str) -> str:
    """Epoch seconds as a zone-less timestamp, whatever the session zone is."""
    return f"timestampadd(SECOND, CAST({seconds} AS BIGINT), {EPOCH})"


def ntz_from_epoch_text(text: str) -> str:
    """Epoch-millisecond text as a timestamp; anything but digits gives NULL."""
    return f"CASE WHEN {text} RLIKE '^[0-9]+$' THEN {ntz_from_millis(text)} END"


def to_zone(zone: str, timestamp: str) -> str:
    """UTC wall time as wall time in `zone`; NULL when the zone is unknown."""
    return f"convert_timezone('UTC', {zone}, {timestamp})"


def second_boundaries(start_millis: str, end_millis: str) -> str:
    """Whole-second boundaries crossed between two epoch-millisecond values."""
    return f"CAST(floor({end_millis} / 1000) - floor({start_millis} / 1000) AS BIGINT)"
