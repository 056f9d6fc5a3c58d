"""Row checks that fail the job from inside an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_fail(value: Column, parsed: Column, what: str, null_fails: bool = False) -> Column:
    """``parsed``, with a failure where it is null although ``value`` is not.

    With ``null_fails`` a null ``value`` fails as well. The outcome is the same
    with ANSI mode on and off.
    """
    shown = F.coalesce(value.cast("string"), F.lit("null"))
    failure = F.raise_error(F.concat(F.lit(f"{what}: "), shown))
    return F.coalesce(parsed, failure if null_fails else F.when(value.isNotNull(), failure))
