"""File and column names; parts of a drop-file name ``F<six date digits><version>.<ext>``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.functions.dates import strict_date, tolerant_date


def quoted(name: str) -> str:
    """A column name as it has to be written when it holds blanks or dots."""
    return "`" + name.replace("`", "``") + "`"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def plain_name(encoded: Column) -> Column:
    """``_metadata`` names are percent-encoded; give back the name on disk."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), decoded).otherwise(encoded)


def file_stem(name: Column) -> Column:
    """Name without its extension."""
    return F.regexp_replace(name, r"(?s)(.)\.[^.]*$", "$1")


def file_id(name: Column, length: int | None = None) -> Column:
    """Name without its extension, or its first ``length`` characters.

    Names of one version letter have eight characters before the extension, so that both agree on them.
    """
    return file_stem(name) if length is None else F.substring(name, 1, length)


def id_text(name: str, length: int | None = None) -> str:
    """``file_id`` of one name."""
    return (re.sub(r"(?s)(.)\.[^.]*$", r"\1", name)) if length is None else name[:length]


def file_version(name: Column) -> Column:
    """Text between the date digits and the extension."""
    kept = F.length(name) - (fixed.FILE_VERSION_START - 1 + fixed.FILE_EXTENSION_LENGTH)
    return F.substring(name, F.lit(fixed.FILE_VERSION_START), kept)


def file_date(name: Column, pattern: str = fixed.FILE_DATE_PATTERN, strict: bool = True) -> Column:
    digits = F.substring(name, fixed.FILE_DATE_START, fixed.FILE_DATE_LENGTH)
    if strict:
        return strict_date(digits, pattern, label="file name date")
    return tolerant_date(digits, pattern)
