"""Parsed rows against non-blank raw lines, per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotmill.sources.prelog import line_profile


def loaded_counts(rows: DataFrame, name: str = "source_file") -> DataFrame:
    return rows.groupBy(F.col(name).alias("file_name")).agg(F.count("*").alias("loaded_rows"))


def reconcile(rows: DataFrame, lines: DataFrame, name: str = "source_file") -> DataFrame:
    """file_name, loaded_rows, nonblank_lines, matched.

    Both sides are counted before they meet, so only one row per file is shuffled.
    """
    raw = line_profile(lines, by=[name]).select(F.col(name).alias("file_name"), "nonblank_lines")
    return compare_counts(loaded_counts(rows, name).join(raw, "file_name", "full_outer"))


def compare_counts(counts: DataFrame) -> DataFrame:
    loaded = F.coalesce("loaded_rows", F.lit(0))
    nonblank = F.coalesce("nonblank_lines", F.lit(0))
    return counts.select(
        "file_name",
        loaded.alias("loaded_rows"),
        nonblank.alias("nonblank_lines"),
        (loaded == nonblank).alias("matched"),
    )
