"""Integer casts for report columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotmill.functions.checks import or_fail


def whole_number(value: Column, dtype: T.DataType | None = None) -> Column:
    """64-bit integer; null for anything else, including numbers with a fraction."""
    parsed = value.try_cast("bigint")
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        parsed = F.when(parsed == value, parsed)
    return parsed


def strict_int(
    value: Column, dtype: T.DataType | None = None, label: str = "integer", null_fails: bool = False
) -> Column:
    """64-bit integer; fails on anything else, including numbers with a fraction."""
    return or_fail(value, whole_number(value, dtype), f"not a whole number in {label}", null_fails)


def lenient_text(value: Column) -> Column:
    """Whole numbers in plain form, every other text as it is."""
    return F.coalesce(value.try_cast("bigint").cast("string"), value)


# an integer, decimal or exponent form; no words such as NaN, no type letters
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(value: Column) -> Column:
    """The number behind any numeric text, with fraction or exponent or beyond 64 bits; null for other text."""
    return F.when(value.rlike(NUMBER), F.trim(value).try_cast("double"))


def lenient_number(value: Column) -> Column:
    """The 64-bit integer behind ``lenient_text``, null where the text is not one."""
    return value.try_cast("bigint")


def lenient_variant(value: Column) -> Column:
    """The value of each cell by itself: a whole number, a number, or text. Null stays null."""
    return F.coalesce(lenient_number(value).cast("variant"), lenient_double(value).cast("variant"), value.cast("variant"))
