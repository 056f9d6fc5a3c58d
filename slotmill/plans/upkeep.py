"""Upkeep of what runs leave behind: log, run records, register and replaced loads.

Appends of single rows leave a file each. Upkeep picks the folders that hold more
files than a bound and writes their rows into a few. New files are put beside the
old ones before those are removed. A reader in between, or a stop there, sees a
row twice, which changes no current version, record or registration, since the
newest of equal keys is taken. A query that listed the files before they went
has to be run again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill.operators import runlog
from slotmill.operators.newest import newest_by
from slotmill.plans.audit import AUDIT_SCHEMA
from slotmill.sources import storage
from slotmill.sources.loaded import REGISTER, REGISTER_SCHEMA, day_folder, register_rows, superseded

#: files of a folder that upkeep leaves alone, and bytes of a file that it writes
MOST_FILES = 8
FILE_BYTES = 128_000_000


def merge_folder(
    spark: SparkSession,
    folder: str,
    schema: str,
    most_files: int = MOST_FILES,
    file_bytes: int = FILE_BYTES,
    kept: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Write the rows of a folder into few files if it holds more than ``most_files``; returns the files taken away.

    ``kept`` may leave rows out. Files that are added meanwhile stay as they are.
    """
    old = [e for e in storage.listing(spark, folder) if not e.is_folder and e.name.endswith(".parquet") and not e.name.startswith(("_", "."))]
    if len(old) <= most_files:
        return 0
    staging = f"{folder}/_merge-{uuid.uuid4().hex}"
    rows = kept(spark.read.schema(schema).parquet(*[storage.literal(e.path) for e in old]))
    files = max(1, -(-sum(e.length for e in old) // file_bytes))
    try:
        rows.repartition(files).write.parquet(staging)
        for part in storage.listing(spark, staging):
            if part.name.startswith("part-"):
                storage.move(spark, part.path, f"{folder}/{part.name}")
    finally:
        storage.remove(spark, staging)
    for entry in old:
        storage.remove(spark, entry.path)
    return len(old)


def _days(spark: SparkSession, path: str, prefix: str) -> list[tuple[date, str]]:
    folders = [name for name, is_folder in storage.entries(spark, path) if is_folder and name.startswith(prefix)]
    return [(date.fromisoformat(name.removeprefix(prefix)), f"{path}/{name}") for name in sorted(folders)]


def compact_log(spark: SparkSession, path: str, before: date, most_files: int = MOST_FILES, drop_superseded: bool = False) -> int:
    """Merge the days of a task log that are over ``before`` and have too many files; returns the files taken away.

    With ``drop_superseded`` only the current version of each row is kept of those days, which is looked up
    in the whole log.
    """
    days = [folder for day, folder in _days(spark, path, "event_date=") if day < before]
    if not drop_superseded:
        return sum(merge_folder(spark, folder, runlog.VERSION_SCHEMA, most_files) for folder in days)
    # written down first: files of the log go while it is compacted
    place = f"{path}/_newest-{uuid.uuid4().hex}"
    newest_by(runlog.read_log(spark, path), ["log_id"], ["seq"], ["seq", "event_ts"]).write.parquet(place)
    newest = spark.read.schema("log_id string, seq bigint").parquet(place)

    def current(rows: DataFrame) -> DataFrame:
        alone = rows.filter(F.col("log_id").isNull())
        return rows.join(newest, ["log_id", "seq"], "left_semi").select(rows.columns).unionByName(alone)

    try:
        return sum(merge_folder(spark, folder, runlog.VERSION_SCHEMA, most_files, kept=current) for folder in days)
    finally:
        storage.remove(spark, place)


def compact_audit(spark: SparkSession, path: str, most_files: int = MOST_FILES) -> int:
    """Merge the run records, without the earlier records of a repeated run; returns the files taken away."""
    names = [field.split()[0] for field in AUDIT_SCHEMA.split(", ")]

    def newest(rows: DataFrame) -> DataFrame:
        return newest_by(rows, ["run_id"], [n for n in names if n != "run_id"], ["run_ts"]).select(names)

    return merge_folder(spark, path, AUDIT_SCHEMA, most_files, kept=newest)


def compact_register(spark: SparkSession, target: str, most_files: int = MOST_FILES) -> int:
    """Merge the register of each import day, keeping the last two registrations of a file; returns the files taken away."""
    schema = REGISTER_SCHEMA.removesuffix(", import_date date")
    names = [field.split()[0] for field in schema.split(", ")]

    def last_two(rows: DataFrame) -> DataFrame:
        newest = F.slice(F.sort_array(F.collect_list(F.struct("seq", *[n for n in names if n != "seq"])), asc=False), 1, 2)
        return rows.distinct().groupBy("file_name").agg(newest.alias("newest")).select(F.inline("newest")).select(names)

    place = f"{target}/{REGISTER}"
    if not storage.exists(spark, place):
        return 0
    return sum(merge_folder(spark, folder, schema, most_files, kept=last_two) for _, folder in _days(spark, place, "import_date="))


def remove_unused_loads(spark: SparkSession, target: str, import_date: date, hours: float = 24.0) -> int:
    """Remove what no reader needs any more of a day: replaced files and loads that were never registered; returns folders removed.

    Only folders older than ``hours`` go, so that loads and readers that are under way keep theirs. Run it
    before ``compact_register``, which forgets what was replaced long ago.
    """
    day = day_folder(target, import_date)
    if not storage.exists(spark, day):
        return 0
    youngest, removed = time.time() - hours * 3600, 0
    loads = {e.name.removeprefix("load="): e for e in storage.listing(spark, day) if e.is_folder and e.name.startswith("load=")}
    registered = {r.load for r in register_rows(spark, target, import_date).select("load").distinct().toLocalIterator()}
    gone = [f"{day}/load={n}" for n, e in loads.items() if n not in registered and e.modified / 1000 <= youngest]
    for row in superseded(spark, target, import_date, keep=0).toLocalIterator():
        place = f"{day}/load={row.load}/file_name={storage.partition_value(spark, row.file_name)}"
        entry = loads.get(row.load)
        if entry and entry.modified / 1000 <= youngest and storage.exists(spark, place):
            gone.append(place)
    for place in gone:
        storage.remove(spark, place)
        removed += 1
    return removed
