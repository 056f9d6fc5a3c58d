"""The fixed list of exclusive titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill import fixed


def exclusive_titles(spark: SparkSession, titles: Sequence[str] = fixed.EXCLUSIVE_TITLES) -> DataFrame:
    """One column, in list order, in a single partition so that the file keeps the order."""
    return spark.createDataFrame([(title,) for title in titles], f"`{fixed.TITLE_COLUMN}` string").coalesce(1)


def rows_with_titles(df: DataFrame, column: str, titles: Sequence[str] = fixed.EXCLUSIVE_TITLES) -> DataFrame:
    """Rows whose title is in the list. The list is part of the filter, so it reaches the scan."""
    return df.filter(F.col(column).isin(list(titles)))
