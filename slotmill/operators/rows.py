"""Frames of a single row, built inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_row(spark: SparkSession, schema: str, values: Mapping[str, object]) -> DataFrame:
    """One row in one partition; columns without a value are null."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(0, 1, 1, 1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields])
