"""Timestamp text and day keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTE_TEXT_LENGTH = 16  # "2026-07-12T07:30": no seconds, no zone


def utc_marked(text: Column, rule: str = "tolerant") -> Column:
    """Complete timestamp text to an explicit UTC instant.

    ``tolerant`` leaves text that already ends in ``Z`` alone; ``always`` appends the mark to
    anything, which turns a marked text into an unreadable one.
    """
    if rule not in ("tolerant", "always"):
        raise ValueError(f"unknown timestamp rule {rule!r}")
    completed = F.concat(text, F.when(F.length(text) == MINUTE_TEXT_LENGTH, ":00Z").otherwise("Z"))
    return completed if rule == "always" else F.when(text.endswith("Z"), text).otherwise(completed)


def to_milliseconds(instant: Column) -> Column:
    """Cut an instant to three fractional digits."""
    return F.date_trunc("MILLISECOND", instant)


def day_of(instant: Column, day_type: str = "date") -> Column:
    """The UTC day of an instant, as a DATE or as ``yyyy-MM-dd`` text."""
    if day_type == "date":
        return F.to_date(instant)
    if day_type == "string":
        return F.date_format(instant, "yyyy-MM-dd")
    raise ValueError(f"day_type must be 'date' or 'string', not {day_type!r}")


def run_stamp(instant: Column) -> Column:
    """Compact UTC stamp of a run, ``20260712T073000Z``."""
    return F.date_format(instant, "yyyyMMdd'T'HHmmss'Z'")
