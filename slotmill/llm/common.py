"""Helpers shared by the text operators."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder shared by driver and executors and read back, which ends the lineage."""
    spark = df.sparkSession
    folder = f"{work_folder(spark, label)}/rows"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {name.lower() for name in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def held_out(doc_id: Column, parts: int, remainder: int) -> Column:
    """The id is of the fold with that remainder; false for a null id, which is of no fold."""
    return F.coalesce(fold(doc_id, parts) == remainder, F.lit(False)).alias("held_out")


def bounded_sample(df: DataFrame, rows: int, *key: Column) -> DataFrame:
    """About ``rows`` rows of ``df`` chosen by a hash of ``key``, and never over twice as many.

    Only for fitting models. All rows are returned when there are no more than ``rows``.
    """
    total = df.count()
    if total <= rows:
        return df
    grain = 1 << 40
    picked = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(grain)) < F.lit(int(grain * rows / total))
    return df.filter(picked).limit(2 * rows)


def text_hash(word: bytes, size: int) -> int:
    return zlib.crc32(word) % size


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def rounded(x: float) -> float:
    """A probability that is never NaN or outside 0 to 1."""
    return 0.5 if math.isnan(x) else min(1.0, max(0.0, float(x)))


def batches_of(rows: Iterable, size: int) -> Iterator[list]:
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch
