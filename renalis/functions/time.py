"""Date and time columns. Timestamps are zone-free, as in the clinical tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def combine_date_time(day: Column, time: Column, missing: str = "null") -> Column:
    """Calendar date plus 'HH:mm' text. A missing time gives NULL, or midnight on request."""
    if missing == "midnight":
        time = F.coalesce(time, F.lit("00:00"))
    text = F.concat(day.cast("date").cast("string"), F.lit(" "), time)
    return text.cast("timestamp_ntz")


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_day(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, by interval arithmetic, which knows no time zone."""
    return (end - start).cast("interval second").cast("long")


def epoch_seconds(ts: Column) -> Column:
    return seconds_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def days_between(start: Column, end: Column, mode: str) -> Column:
    """Days from start to end, in one of three senses.

    exact: 24-hour days rounded down; whole: 24-hour days cut towards zero; boundary: midnights
    crossed.
    """
    if mode == "boundary":
        return F.datediff(end, start)
    days = seconds_between(start, end) / F.lit(DAY_SECONDS)
    if mode == "whole":
        return F.when(days < 0, F.ceil(days)).otherwise(F.floor(days)).cast("int")
    return F.floor(days).cast("int")


def hours_between(start: Column, end: Column, mode: str) -> Column:
    """Hours from start to end: hour marks crossed for 'boundary', else rounded half up."""
    if mode == "boundary":
        start_hour = F.floor(epoch_seconds(start) / F.lit(3600))
        end_hour = F.floor(epoch_seconds(end) / F.lit(3600))
        return (end_hour - start_hour).cast("int")
    return F.round(seconds_between(start, end) / F.lit(3600)).cast("int")
