"""Exact time arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def minutes_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_MINUTE))


def slot_start(ts: Column, width_minutes: int) -> Column:
    """Start of the fixed-width slot holding ``ts``, in microseconds since 1970."""
    micros = micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return micros - F.pmod(micros, F.lit(width_minutes * MICROS_PER_MINUTE))


def compact_time(ts: Column) -> Column:
    """``yyyyMMddHHmmss`` text, built from the printed value so no session time zone is involved."""
    return F.translate(F.substring(ts.cast("string"), 1, 19), "-: ", "")
