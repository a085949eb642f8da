"""Dates and hours out of epoch milliseconds and time strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_of_millis(millis: Column) -> Column:
    """`yyyy-MM-dd` in the session zone."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def hour_of_millis(millis: Column) -> Column:
    """`HH` in the session zone."""
    return F.date_format(F.timestamp_millis(millis), "HH")


def date_part(text: Column) -> Column:
    """Date of `yyyy-MM-dd HH:mm:ss`, as text."""
    return F.substring_index(text, " ", 1)


def hour_part(text: Column) -> Column:
    """Two-digit hour of `yyyy-MM-dd HH:mm:ss`; null when there is no time part."""
    return F.substring_index(F.try_element_at(F.split(text, " "), F.lit(2)), ":", 1)


def stream_time(text: Column) -> Column:
    """Time of `yyyy-MM-dd HH:mm:ss` for a stream, whose watermark starts at 1970: no time and all before is 1970-01-02."""
    return F.greatest(F.try_to_timestamp(text), F.lit("1970-01-02 00:00:00").cast("timestamp"))


def now_text(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Processing time as text; one value per batch."""
    return F.date_format(F.current_timestamp(), pattern)
