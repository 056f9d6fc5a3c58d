"""Source and import stamps on raw rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.functions.dates import strict_date, tolerant_date
from slotmill.functions.names import file_id


def stamp(
    df: DataFrame,
    import_date: date,
    source: Column | None = None,
    id_length: int | None = None,
) -> DataFrame:
    """``file_name`` and ``import_date`` in front of the other columns.

    The import date is one value for the whole run, so that a run over midnight
    writes the same key that it looked up.
    """
    name = F.col("source_file") if source is None else source
    rest = [c for c in df.columns if c != "source_file"]
    return df.select(
        file_id(name, id_length).alias("file_name"), F.lit(import_date).alias("import_date"), *rest
    )


def type_tx_date(df: DataFrame, column: str = "TX_DATE", strict: bool = False) -> DataFrame:
    """Schedule date from ``yyyyMMdd`` text: null when it is none, or a failure with ``strict``."""
    parse = strict_date if strict else tolerant_date
    return df.withColumn(column, parse(F.col(column), fixed.TX_DATE_PATTERN))
