"""Timestamps, durations and date parts (session zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(seconds)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes as a double, from whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def year_of(ts: Column | str) -> Column:
    return F.year(ts).cast("bigint")


def month_of(ts: Column | str) -> Column:
    return F.month(ts).cast("bigint")


def weekday(ts: Column | str) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def is_weekend(ts: Column | str) -> Column:
    return weekday(ts).isin(0, 6)
