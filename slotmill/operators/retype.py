"""Typed dates beside the display text of a finished report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotmill import fixed
from slotmill.functions.dates import tolerant_date
from slotmill.functions.names import quoted

DATE_SUFFIX = "_DATE"


def retype_date_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<name>_DATE`` for each named column that exists; text that is no date stays text only."""
    typed = {}
    for field in df.schema.fields:
        if field.name in columns:
            value = F.col(quoted(field.name))
            is_text = isinstance(field.dataType, T.StringType)
            typed[field.name + DATE_SUFFIX] = tolerant_date(value, fixed.DISPLAY_DATE_PATTERN) if is_text else value.cast("date")
    return df.withColumns(typed)
