"""Discovery in the landing area: newest day folder first, then its newest file version.

The folder is settled before file names are looked at, so a newest folder
without a matching file is an error and never a reason to use an older one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.errors import DuplicateFileId, MissingInput, NoDayFolder
from slotmill.functions.dates import strict_date, tolerant_date
from slotmill.functions.names import file_date, file_id, file_version, id_text
from slotmill.sources import storage


@dataclass(frozen=True)
class Drop:
    """The file a run works on; one ``in_parts`` is a folder that holds them."""

    path: str
    file: str
    file_id: str
    folder: date
    in_parts: bool = False


def landing_entries(spark: SparkSession, root: str) -> DataFrame:
    """Names directly below the root, empty folders included. A missing root raises."""
    return spark.createDataFrame(storage.entries(spark, root), "name string, is_folder boolean")


def in_day_folder(folder: Column, year_prefix: str | None = None) -> Column:
    """The name is a date; with ``year_prefix`` it begins with that, whatever follows."""
    if year_prefix is None:
        return tolerant_date(folder, fixed.FOLDER_DATE_PATTERN).isNotNull()
    return folder.startswith(year_prefix)


def day_folders(entries: DataFrame, year_prefix: str | None = None) -> DataFrame:
    kept = entries.filter(F.col("is_folder") & in_day_folder(F.col("name"), year_prefix))
    return kept.select(F.col("name").alias("folder"))


def latest_folder(folders: DataFrame, year_prefix: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Newest folder date. Without a prefix names that are no dates are passed over, with one they fail the job."""
    kept = folders.filter(in_day_folder(F.col("folder"), year_prefix))
    day = strict_date(F.col("folder"), fixed.FOLDER_DATE_PATTERN, label="folder date")
    return kept.groupBy(*by).agg(F.max(day).alias("latest_folder"))


def folder_files(spark: SparkSession, folder: str, parts: bool = False) -> DataFrame:
    """Files directly in one folder, those without content too; contents are not read.

    With ``parts`` its folders are listed too, each as a file in parts; their ``length`` says nothing.
    """
    files = [(e.name, e.path, e.length) for e in storage.listing(spark, folder) if parts or not e.is_folder]
    return spark.createDataFrame(files, "file string, path string, length long")


def is_candidate(file: Column, file_prefix: str | None = None) -> Column:
    """The name begins with the prefix; without one, with the letter and six digits of a drop file."""
    if file_prefix is None:
        return file.rlike(f"^{fixed.FILE_PREFIX}[0-9]{{{fixed.FILE_DATE_LENGTH}}}")
    return file.startswith(file_prefix)


def candidate_files(files: DataFrame, file_prefix: str | None = None) -> DataFrame:
    return files.filter(is_candidate(F.col("file"), file_prefix))


def newest_version(
    files: DataFrame,
    by: Sequence[str] = (),
    date_pattern: str = fixed.FILE_DATE_PATTERN,
    strict: bool = True,
    file: str = "file",
) -> DataFrame:
    """Per group, the file with the latest name date, then the highest version text."""
    name = F.col(file)
    order = F.struct(file_date(name, date_pattern, strict), file_version(name), name)
    return files.groupBy(*by).agg(F.max_by(name, order).alias("latest_file"))


def shared_file_ids(files: DataFrame, file: str = "file", id_length: int | None = None) -> DataFrame:
    """File ids that stand for more than one distinct name."""
    names = files.select(file_id(F.col(file), id_length).alias("file_id"), F.col(file).alias("name")).distinct()
    return names.groupBy("file_id").agg(F.count("*").alias("names")).filter(F.col("names") > 1)


def require_distinct_ids(files: DataFrame, file: str = "file", id_length: int | None = None) -> None:
    clash = shared_file_ids(files, file, id_length).take(5)
    if clash:
        raise DuplicateFileId(", ".join(row.file_id for row in clash))


def find_latest_drop(
    spark: SparkSession,
    root: str,
    year_prefix: str | None = None,
    file_prefix: str | None = None,
    date_pattern: str = fixed.FILE_DATE_PATTERN,
    id_length: int | None = None,
    parts: bool = False,
) -> Drop:
    """The newest file of the newest day folder, or ``MissingInput``; with ``parts`` it may be a file in parts."""
    folder = latest_folder(day_folders(landing_entries(spark, root), year_prefix), year_prefix).first()[0]
    if folder is None:
        raise NoDayFolder(f"no day folder{f' starting with {year_prefix}' if year_prefix else ''} in {root}")
    location = f"{root.rstrip('/')}/{folder.isoformat()}"
    candidates = candidate_files(folder_files(spark, location, parts), file_prefix)
    newest = newest_version(candidates, date_pattern=date_pattern).first()[0]
    if newest is None:
        raise MissingInput(f"no {file_prefix or fixed.FILE_PREFIX} file in {location}")
    path = f"{location}/{newest}"
    return Drop(path, newest, id_text(newest, id_length), folder, parts and storage.is_folder(spark, path))
