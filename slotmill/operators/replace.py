"""Keyed loads: a rerun of a key replaces the rows of its earlier load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.errors import EmptyLoad
from slotmill.operators.sizing import gather_by


def key_filter(df: DataFrame, **key) -> DataFrame:
    """Rows whose columns equal the given values, compared exactly."""
    for column, value in key.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def existing_rows(df: DataFrame, **key) -> DataFrame:
    """One row: how many rows already carry the key."""
    return key_filter(df, **key).agg(F.count("*").alias("existing_rows"))


def replace_by_key(target: DataFrame, new: DataFrame, keys: Sequence[str] = fixed.LOAD_KEY) -> DataFrame:
    """``target`` without the rows of any key in ``new``, plus ``new``. A null in a key equals a null."""
    incoming = new.select(*[F.col(key).alias(f"_new_{n}") for n, key in enumerate(keys)]).distinct()
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_new_{n}")) for n, key in enumerate(keys)])
    return target.join(incoming, same, "left_anti").unionByName(new)


def write_replacing(
    df: DataFrame,
    target: str,
    keys: Sequence[str] = fixed.LOAD_KEY,
    gather: bool = False,
) -> int:
    """Overwrite the partitions that ``df`` touches and leave all others; returns the rows written.

    Rows read from drop files lie together by key already, so they are written
    where they are, without a shuffle. ``gather`` is for rows whose keys are
    spread over all tasks: it brings keys together, a hot one in several parts.
    """
    written = Observation()
    rows = gather_by(df, keys) if gather else df
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(target)
    )
    count = written.get.get("rows") or 0
    if count == 0:
        raise EmptyLoad(f"no rows for {target}; nothing was replaced")
    return count
