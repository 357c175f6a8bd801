"""Column expressions shared by the jobs; all run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two times without zone; no session zone is involved."""
    return (_col(end) - _col(start)).cast("interval second").cast("bigint")


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    return duration_seconds(start, end) / F.lit(60.0)


def mean_minutes(start: Column | str, end: Column | str) -> Column:
    """Average duration in minutes; whole seconds are summed, so the result has no summation-order error."""
    return F.avg(duration_seconds(start, end)) / F.lit(60.0)


def parse_ts(text: Column | str) -> Column:
    """Text to a time without zone, so no session zone can shift a duration."""
    return F.to_timestamp_ntz(_col(text), F.lit(TIMESTAMP_FORMAT))


def format_ts(time: Column | str) -> Column:
    """A time as ``yyyy-MM-dd HH:mm:ss`` text; parts of a second are cut off."""
    return F.substring(_col(time).cast("string"), 1, 19)


def add_time(base: Column, days=0, hours=0, minutes=0, seconds=0) -> Column:
    parts = [F.lit(p) if isinstance(p, int) else p.cast("int") for p in (days, hours, minutes)]
    return base + F.make_dt_interval(*parts, F.lit(seconds) if isinstance(seconds, int) else seconds)


def trip_cost(minutes: Column, surcharge: Column) -> Column:
    """One to unlock, 0.15 a minute and a surcharge, to the cent."""
    return F.round(F.lit(1.0) + minutes * F.lit(0.15) + surcharge, 2)


def at_least_one(value: Column) -> Column:
    return F.greatest(value, F.lit(1))


def full_name(city: Column | str, suffix: Column | str) -> Column:
    return F.concat_ws(" ", _col(city), _col(suffix))


def or_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
