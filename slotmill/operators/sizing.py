"""Gathering rows by key without handing a hot key to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gather_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a key together, but never a hot key into one task.

    Adaptive execution merges small keys and cuts large ones by size. Without it every key is split
    into as many parts as there are shuffle partitions, by a hash of the row.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *keys)
    hashed = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    place = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
    return df.repartition(*keys, place)


def _has_map(kind: T.DataType) -> bool:
    """Maps cannot be hashed."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)
