"""Date parsing and display."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.functions.checks import or_fail


def as_day(day: date | str) -> date:
    """A date, from a date or ``YYYY-MM-DD`` text."""
    return date.fromisoformat(day) if isinstance(day, str) else day


def tolerant_date(text: Column, pattern: str) -> Column:
    """Date, or null where the text does not fit the pattern."""
    return F.try_to_date(text, pattern)


def strict_date(
    value: Column, pattern: str | None = None, label: str = "date", null_fails: bool = False
) -> Column:
    """Date; fails on text that is not one, and on nulls if asked to."""
    parsed = value.try_cast("date") if pattern is None else F.try_to_date(value, pattern)
    return or_fail(value, parsed, f"not a {label}", null_fails)


def display_date(value: Column, pattern: str = fixed.DISPLAY_DATE_PATTERN) -> Column:
    return F.date_format(value, pattern)
