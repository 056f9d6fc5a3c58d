"""Line and null tests on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotmill import fixed

# A character that is no Unicode blank; the four separators U+001C..U+001F count as blank too.
NON_BLANK = r"(?U)[^\s\x1c-\x1f]"


def is_nonblank(line: Column) -> Column:
    return line.rlike(NON_BLANK)


def field_count(line: Column, sep: str = "\t") -> Column:
    """Fields of a line under a separator of one byte; quotes are not looked at."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(sep), F.lit(""))) + 1


def null_text(value: Column, sentinel: str = fixed.NULL_SENTINEL) -> Column:
    """Nulls as sentinel text. Empty strings are kept."""
    return F.coalesce(value, F.lit(sentinel))
