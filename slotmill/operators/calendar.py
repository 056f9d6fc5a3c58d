"""Holiday and weekend flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill.functions.dates import as_day
from slotmill.operators.rows import one_row

WEEKEND = (1, 7)  # Spark counts Sunday as 1


def holiday_flags(df: DataFrame, day: str, holidays: DataFrame, include_weekend: int, flag: str = "is_holiday") -> DataFrame:
    """Adds ``flag``: the day is in ``holidays(date)``, or a weekend day when those count."""
    if include_weekend not in (0, 1):
        raise ValueError(f"include_weekend must be 0 or 1, not {include_weekend!r}")
    listed = holidays.select(F.col("date").alias(day)).distinct().withColumn("_listed", F.lit(True))
    joined = df.join(listed, day, "left")
    is_holiday = F.col("_listed").isNotNull()
    if include_weekend:
        is_holiday = is_holiday | F.dayofweek(day).isin(*WEEKEND)
    return joined.select(*df.columns, is_holiday.alias(flag))


def is_holiday(spark: SparkSession, ref_date: date | str, include_weekend: int, holidays: DataFrame) -> bool:
    one_day = one_row(spark, "day date", {"day": as_day(ref_date)})
    return holiday_flags(one_day, "day", holidays, include_weekend).first().is_holiday
