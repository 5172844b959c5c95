"""Durations, time buckets and effective times, as column expressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = (("d", 86_400_000_000), ("h", 3_600_000_000), ("m", 60_000_000), ("s", 1_000_000))
CONTINUOUS = timedelta(microseconds=1)
EPOCH = datetime(1970, 1, 1)


def instant_micros(moment: datetime) -> int:
    """Microseconds since the epoch; a moment without a zone is UTC."""
    naive = moment.replace(tzinfo=None) - (moment.utcoffset() or timedelta(0))
    return (naive - EPOCH) // timedelta(microseconds=1)


def micros(duration: timedelta) -> int:
    """Exact length of a duration in microseconds; it must be positive."""
    value = duration // timedelta(microseconds=1)
    if value <= 0:
        raise ValueError(f"duration must be positive: {duration}")
    return value


def label(duration: timedelta) -> str:
    """Name of a duration in its largest whole unit: 10m, 1h, 3d."""
    if duration == CONTINUOUS:
        return "continuous"
    value = micros(duration)
    for unit, size in _UNITS:
        if value % size == 0:
            return f"{value // size}{unit}"
    return f"{value}us"


def floor_div(value: Column, step: int) -> Column:
    """Whole-number floor division of a long column, right for negatives too."""
    if step == 1:
        return value
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def as_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def bucket(ts: Column, interval: timedelta) -> Column:
    """Number of the epoch-aligned interval that holds ``ts``."""
    return floor_div(as_micros(ts), micros(interval))


def bucket_start(number: Column, interval: timedelta) -> Column:
    return F.timestamp_micros(number * F.lit(micros(interval)))


def effective_micros(ts: Column, schedule: timedelta | None) -> Column:
    """When a row becomes visible: the next schedule boundary after its time."""
    if schedule is None:
        return as_micros(ts)
    step = micros(schedule)
    return (floor_div(as_micros(ts), step) + F.lit(1)) * F.lit(step)


def midnight(ts: Column, days_before: int = 0) -> Column:
    """Start of the day of a time, or of an earlier day."""
    return F.date_trunc("day", ts) - F.make_interval(days=F.lit(days_before))


def date_parts(ts: Column) -> tuple[Column, Column, Column]:
    """Zero-padded year, month and day strings."""
    return F.date_format(ts, "yyyy"), F.date_format(ts, "MM"), F.date_format(ts, "dd")
