"""Headerless tab-separated schedule files under the fixed all-text schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotmill import fixed
from slotmill.functions.names import parent_name, plain_name
from slotmill.functions.text import field_count, is_nonblank

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in fixed.PRELOG_COLUMNS])

PRELOG_SCHEMA = T.StructType(
    [T.StructField("file_name", T.StringType()), T.StructField("import_date", T.DateType())]
    + [
        T.StructField(f.name, T.DateType() if f.name == "TX_DATE" else f.dataType)
        for f in RAW_SCHEMA.fields
    ]
)


def _source_file(parts: bool) -> Column:
    """The name on disk of the file that a row is from; of a file in parts, which is a folder, the name of that."""
    return plain_name(parent_name(F.col("_metadata.file_path")) if parts else F.col("_metadata.file_name"))


def read_prelog(spark: SparkSession, paths: str | Sequence[str], quote: str = "", parts: bool = False) -> DataFrame:
    """The 25 raw columns and ``source_file``.

    Blank lines are skipped, short rows padded with null, extra fields dropped.
    With the default ``quote`` a quote sign is plain text; ``'"'`` turns quoting on.
    With ``parts`` the paths are parts of files, and ``source_file`` names the folder they lie in.
    """
    rows = (
        spark.read.schema(RAW_SCHEMA)
        .option("sep", "\t")
        .option("header", False)
        .option("quote", quote)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    return rows.select("*", _source_file(parts).alias("source_file"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], parts: bool = False) -> DataFrame:
    """Raw lines as ``value``, with ``source_file``; ``parts`` as in ``read_prelog``."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select("value", _source_file(parts).alias("source_file"))


def is_row(line: Column) -> Column:
    """The row reader makes a row of the line: it holds more than characters up to the space."""
    return line.rlike(r"[^\x00-\x20]")


def _fields_of(value: Column, quote: str, corrupt: str | None = None) -> Column:
    fields = [f"{f.name} string" for f in RAW_SCHEMA.fields] + ([f"{corrupt} string"] if corrupt else [])
    options = {"sep": "\t", "quote": quote, "mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    return F.from_csv(value, ", ".join(fields), options)


def parsed_lines(lines: DataFrame, *others: str, quote: str = "") -> DataFrame:
    """``read_prelog``'s rows out of ``read_lines``' lines, so that one scan gives both.

    With ``others``, further columns of ``lines``, every line is kept, and those that are no row are null.
    """
    value = F.when(is_row(F.col("value")), F.col("value"))
    kept = lines if others else lines.filter(is_row(F.col("value")))
    return kept.select(_fields_of(value, quote).alias("_row"), "source_file", *others).select("_row.*", "source_file", *others)


def quote_damage(line: Column, quote: str = '"', width: int = len(fixed.PRELOG_COLUMNS)) -> Column:
    """Whether the row reader, when it honours the quote sign, takes other fields from a line than its tabs make.

    A line of the right number of tabs is damaged where the reader finds another number of fields. One of
    too few or too many is damaged where a field begins with a sign that has no end.
    """
    corrupt = "_corrupt"
    shifted = _fields_of(line, quote, corrupt).getField(corrupt).isNotNull()
    sign = re.escape(quote)
    closed = rf"(^|\t){sign}([^{sign}\\]|\\.|{sign}{sign})*{sign}(?=\t|$)"
    opened = F.regexp_replace(line, closed, "$1").rlike(rf"(^|\t){sign}")
    return is_row(line) & F.when(field_count(line) == width, shifted).otherwise(opened)


def damaged_lines(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(source_file, value, fields): the lines that quoting damages, whole, with the fields that their tabs make."""
    value = F.col("value")
    return lines.filter(quote_damage(value, quote)).select("source_file", "value", field_count(value).alias("fields"))


#: what ``line_flags`` says of a line: it is a row, it is not blank, it has too few fields, too many
ROW, NONBLANK, SHORT, LONG = 1, 2, 4, 8


def line_flags(line: Column, width: int = len(fixed.PRELOG_COLUMNS)) -> Column:
    """The tests of ``profile_columns`` and of the row reader as one number for each line."""
    filled, fields = is_nonblank(line), field_count(line)
    tests = {ROW: is_row(line), NONBLANK: filled, SHORT: filled & (fields < width), LONG: filled & (fields > width)}
    return sum((F.when(test, bit).otherwise(0) for bit, test in tests.items()), F.lit(0)).cast("tinyint")


def flag_counts(flags: Column) -> list[Column]:
    names = {"rows": ROW, "nonblank_lines": NONBLANK, "short_rows": SHORT, "long_rows": LONG}
    return [F.count_if(flags.bitwiseAND(bit) != 0).alias(name) for name, bit in names.items()]


def profile_columns(width: int = len(fixed.PRELOG_COLUMNS)) -> list[Column]:
    """Aggregates over ``value``: lines, non-blank ones, and those with too few or too many fields."""
    filled = is_nonblank(F.col("value"))
    fields = field_count(F.col("value"))
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(filled).alias("nonblank_lines"),
        F.count_if(filled & (fields < width)).alias("short_rows"),
        F.count_if(filled & (fields > width)).alias("long_rows"),
    ]


def line_profile(lines: DataFrame, by: Sequence[str] = (), width: int = len(fixed.PRELOG_COLUMNS)) -> DataFrame:
    """Total and non-blank lines, and non-blank lines with too few or too many fields."""
    return lines.groupBy(*by).agg(*profile_columns(width))
