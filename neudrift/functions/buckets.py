"""Bucket starts and time ranges as column expressions."""

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

from neudrift.schema import DEFAULT_PRESET_HOURS, PRESET_HOURS

DAY = 86_400
_UNITS = {"s": 1, "sec": 1, "second": 1, "min": 60, "t": 60, "minute": 60, "h": 3600, "hour": 3600,
          "d": DAY, "day": DAY}


def width_seconds(width) -> int:
    """Bucket width in whole seconds from a number or text such as 60s, 1min, 2h or 1d."""
    if isinstance(width, int):
        seconds = width
    else:
        match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+?)(?<=[A-Za-z])s?\s*", width)
        unit = match and match.group(2).lower()
        if unit not in _UNITS:
            raise ValueError(f"not a bucket width: {width!r}")
        seconds = int(match.group(1) or 1) * _UNITS[unit]
    if seconds < 1:
        raise ValueError("a bucket is at least one second wide")
    return seconds


def divides_day(width) -> bool:
    return DAY % width_seconds(width) == 0


def time_bin(time: Column, seconds: int) -> Column:
    """The number of the `seconds` wide bin, counted from a fixed time, that a time falls into."""
    return F.floor(seconds_between(F.lit("1970-01-01").cast("timestamp_ntz"), time) / seconds).cast("long")


def midnight(day: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz")


def at_midnight(time: Column) -> Column:
    return time == midnight(time)


# Text of zone-less times goes through a cast: date_format would pass through the session's zone,
# in which some local times do not exist.

def day_text(day: Column) -> Column:
    """yyyymmdd of a date or time."""
    return F.replace(day.cast("date").cast("string"), F.lit("-"), F.lit(""))


def clock_text(time: Column) -> Column:
    """yyyy-mm-dd HH:MM:SS."""
    return F.substring(time.cast("string"), 1, 19)


def minute_text(time: Column) -> Column:
    """yyyymmdd-HH:MM."""
    return F.concat_ws("-", day_text(time), F.substring(time.cast("string"), 12, 5))


def hour_text(time: Column) -> Column:
    """yyyymmddHH."""
    return F.concat(day_text(time), F.substring(time.cast("string"), 12, 2))


def bucket_start(time: Column, width, first_day: Column | None = None) -> Column:
    """Start of the left-closed bucket that holds `time`.

    Buckets are anchored at the midnight of `first_day`. When the width divides a day every
    midnight is a bucket edge, so the anchor does not matter and the built-in window is used.
    All arithmetic stays on zone-less timestamps and whole seconds.
    """
    seconds = width_seconds(width)
    if first_day is None:
        if not divides_day(seconds):
            raise ValueError("this width needs the first day of the series as its anchor")
        return F.window(time, f"{seconds} seconds")["start"]
    elapsed = seconds_between(midnight(first_day), time)
    return plus_seconds(midnight(first_day), elapsed - F.pmod(elapsed, F.lit(seconds).cast("long")))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from `start` to `end`, fractions cut off on both sides."""
    def of_day(t):
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * DAY + of_day(end) - of_day(start)


def plus_seconds(time: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return time + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def resolve_range(preset="twodays", start=None, end=None, as_of=None):
    """(start, end, preset) of a plot request; an explicit start switches the preset off.

    `end` defaults to `as_of`, which defaults to the current UTC time, the zone of the files.
    """
    if end is None:
        end = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    if start is not None:
        return start, end, None
    return end - preset_span(preset), end, preset


def preset_span(preset) -> timedelta:
    return timedelta(hours=PRESET_HOURS.get(preset, DEFAULT_PRESET_HOURS))


def parse_moment(text: str) -> datetime:
    """A start or end given as text, yyyymmdd-HH:MM:SS."""
    return datetime.strptime(text, "%Y%m%d-%H:%M:%S")


def ntz(moment) -> Column:
    """A zone-less timestamp literal from a datetime, or a column unchanged."""
    if isinstance(moment, Column):
        return moment
    return F.lit(str(moment)).cast("timestamp_ntz")
