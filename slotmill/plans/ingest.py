"""From drop files to the loaded table: list, claim, read, stamp, type, count, show, register.

A load is written beside the table first. Each line carries what it counts as,
so that one write gives the counts of every file, and everything that may be
wrong with the load is known before any row of the table is replaced. Then the
load's folder is moved into the table, where it shows as soon as it is
registered; a file that has no rows any more is registered without any.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.errors import CountMismatch, DuplicateFileId, EmptyLoad
from slotmill.functions.names import file_id, id_text
from slotmill.operators.rows import one_row
from slotmill.operators.stamp import stamp, type_tx_date
from slotmill.plans.claims import CLAIM_HOURS, claimed
from slotmill.sources import storage
from slotmill.sources.landing import find_latest_drop
from slotmill.sources.loaded import REGISTER_SCHEMA, day_folder, read_register, superseded, write_register
from slotmill.sources.prelog import (
    ROW,
    damaged_lines,
    flag_counts,
    line_flags,
    line_profile,
    parsed_lines,
    quote_damage,
    read_lines,
    read_prelog,
)

LOAD_SCHEMA = (
    "file_name string, import_date date, loaded_rows bigint, replaced_rows bigint, nonblank_lines bigint, "
    "short_rows bigint, long_rows bigint, matched boolean, files bigint, empty_files bigint, skipped_files bigint, "
    "mismatched_files bigint, mismatches string, damaged_lines bigint"
)
COUNTS = ("rows", "nonblank_lines", "short_rows", "long_rows")


@dataclass(frozen=True)
class Source:
    """One file of a load; ``files`` are its path, or those of its parts."""

    path: str
    name: str
    file_id: str
    folder: date | None
    length: int
    files: tuple[str, ...]


@dataclass(frozen=True)
class Load:
    """Counts of one load over all of its files; ``mismatches`` names those whose rows and lines differ, a few of many.

    ``matched`` says that no file mismatches. The counts of each file are in the register.
    ``damaged_lines`` were set aside; they count as lines that are accounted for.
    """

    file_name: str
    import_date: date
    loaded_rows: int
    replaced_rows: int
    nonblank_lines: int
    short_rows: int
    long_rows: int
    matched: bool
    files: int = 1
    empty_files: int = 0
    skipped_files: int = 0
    mismatched_files: int = 0
    mismatches: str | None = None
    damaged_lines: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        return one_row(spark, LOAD_SCHEMA, asdict(self))


def typed_rows(
    spark: SparkSession,
    paths: str | Sequence[str],
    import_date: date,
    quote: str = "",
    id_length: int | None = None,
    strict_dates: bool = False,
) -> DataFrame:
    """The 27 columns of the loaded table, straight from the files."""
    raw = read_prelog(spark, paths, quote)
    return type_tx_date(stamp(raw, import_date, id_length=id_length), strict=strict_dates)


def _folder_day(path: str) -> date | None:
    try:
        return date.fromisoformat(path.rstrip("/").rsplit("/", 2)[-2])
    except (ValueError, IndexError):
        return None


def _is_hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def sources(
    spark: SparkSession, paths: Sequence[str], id_length: int | None = None, missing: str = "raise", parts: bool = False
) -> list[Source]:
    """The files that ``paths`` (files or folders, not patterns) name, those without content included.

    A path that is not there raises, or is passed over with ``missing="skip"``. With ``parts`` every path
    is a folder and one file, whose parts are the files directly in it.
    """
    def of(path: str) -> list[Source]:
        try:
            entries = storage.listing(spark, path)
        except FileNotFoundError:
            if missing == "raise":
                raise
            return []
        files = [e for e in entries if not e.is_folder and not _is_hidden(e.name)]
        if not parts:
            return [Source(e.path, e.name, id_text(e.name, id_length), _folder_day(e.path), e.length, (e.path,)) for e in files]
        if not storage.is_folder(spark, path):
            raise NotADirectoryError(path)
        name, filled = path.rstrip("/").rsplit("/", 1)[-1], [e for e in files if e.length]
        length = sum(e.length for e in filled)
        return [Source(path, name, id_text(name, id_length), _folder_day(path), length, tuple(e.path for e in filled))]

    with ThreadPoolExecutor(storage.THREADS) as pool:
        return [source for found in pool.map(of, paths) for source in found if not _is_hidden(source.name)]


def _chosen(found: list[Source], known: dict, skip_older: bool) -> list[Source]:
    """One source for each id, and only sources that may replace what the register has."""
    by_id: dict[str, Source] = {}
    for source in sorted(found, key=lambda s: (s.folder or date.min, s.path)):
        other = by_id.get(source.file_id)
        if other and (other.name != source.name or not skip_older):
            raise DuplicateFileId(f"{source.file_id}: {other.path}, {source.path}")
        by_id[source.file_id] = source
    for name, row in known.items():
        source = by_id[name]
        if source.name != row.source_file:
            raise DuplicateFileId(f"{name}: loaded from {row.source_file}, not {source.name}")
        if skip_older and row.folder is not None and (source.folder is None or source.folder < row.folder):
            del by_id[name]
    return list(by_id.values())


def _of_ids(spark: SparkSession, rows: DataFrame, ids: Sequence[str]) -> list:
    """Rows of the ids of one load, so a few for each of its files."""
    names = spark.createDataFrame([(i,) for i in ids], "file_name string")
    return list(rows.join(names, "file_name", "left_semi").toLocalIterator())


@dataclass(frozen=True)
class _Reading:
    """How the files of a load are read."""

    quote: str
    id_length: int | None
    strict: bool
    strict_dates: bool
    set_aside: str | None
    parts: bool = False

    @property
    def one_scan(self) -> bool:
        return not self.quote and not self.strict


def _write_counted(spark: SparkSession, files: list[str], staging: str, import_date: date, load: str, how: _Reading) -> dict[str, dict[str, int]]:
    """Write the rows of all files below ``staging``; returns the counts of each file id."""
    lines = read_lines(spark, files, how.parts)
    if how.one_scan:
        flags = line_flags(F.col("value"))
        raw = parsed_lines(lines.withColumn("line_flags", flags).filter("line_flags <> 0"), "line_flags")
    else:
        sound = how.quote and how.set_aside
        rows = parsed_lines(lines.filter(~quote_damage(F.col("value"), how.quote)), quote=how.quote) if sound else read_prelog(spark, files, how.quote, how.parts)
        raw = rows.withColumn("line_flags", F.lit(ROW).cast("tinyint"))
    # a line that counts as one without being a row is written too, but left behind in the staging folder
    place = F.when(F.col("line_flags").bitwiseAND(ROW) != 0, F.lit(load)).otherwise(f"{load}-lines")
    rows = type_tx_date(stamp(raw, import_date, id_length=how.id_length), strict=how.strict_dates)
    rows.withColumn("load", place).write.partitionBy("import_date", "load", "file_name").parquet(staging)

    schema = "line_flags tinyint, import_date date, load string, file_name string"
    written = spark.read.schema(schema).parquet(staging).groupBy("file_name").agg(*flag_counts(F.col("line_flags")))
    counts = {r.file_name: r.asDict() for r in written.toLocalIterator()}
    if not how.one_scan:
        named = lines.withColumn("file_name", file_id(F.col("source_file"), how.id_length))
        for row in line_profile(named, by=["file_name"]).toLocalIterator():
            counts.setdefault(row.file_name, {"rows": 0}).update({c: row[c] for c in COUNTS[1:]})
        if sound:
            aside = f"{how.set_aside}/import_date={import_date.isoformat()}/load={load}"
            damaged_lines(lines, how.quote).withColumn("file_name", file_id(F.col("source_file"), how.id_length)).write.parquet(aside)
            for row in spark.read.parquet(aside).groupBy("file_name").count().toLocalIterator():
                counts[row.file_name]["damaged"] = row["count"]
    return counts


def load_files(
    spark: SparkSession,
    paths: Sequence[str],
    target: str,
    import_date: date,
    quote: str = "",
    id_length: int | None = None,
    strict: bool = False,
    strict_dates: bool = False,
    skip_older: bool = False,
    missing: str = "raise",
    owner: str | None = None,
    claim_hours: float = CLAIM_HOURS,
    set_aside: str | None = None,
    parts: bool = False,
) -> Load:
    """Load files so that each (import date, file id) holds exactly the rows of this load.

    Readers see all of it or nothing. A file without rows, zero bytes among them, takes away what its id
    held; ``strict`` raises ``EmptyLoad`` instead, and ``CountMismatch`` where rows and non-blank lines of
    a file differ, before anything is replaced. An id that another file name was loaded under raises
    ``DuplicateFileId``, one that is being loaded by another ``owner`` raises ``FileClaimed``.
    ``skip_older`` is for arrivals in any order: of copies in several day folders the newest counts, and a
    copy from an older folder than the loaded one is passed over.
    With quoting on, an unbalanced sign shifts the fields behind it. ``set_aside`` names a folder for such
    lines: they are written there as they are, by import date and load, instead of being loaded.
    The files are read once; with quoting on, and with ``strict``, lines are counted in a second scan.
    With ``parts`` each path is a folder that holds one file in parts, as many tasks write it, and is named
    like that file.
    """
    found = sources(spark, paths, id_length, missing, parts)
    how = _Reading(quote, id_length, strict, strict_dates, set_aside, parts)
    seq = time.time_ns()
    load = f"{seq}-{uuid.uuid4().hex[:8]}"
    ids = sorted({s.file_id for s in found})
    with claimed(spark, target, import_date, ids, owner or load, claim_hours):
        known = {r.file_name: r for r in _of_ids(spark, read_register(spark, target, import_date), ids)}
        chosen = _chosen(found, known, skip_older)
        return _load_claimed(spark, paths, found, chosen, known, target, import_date, seq, load, how)


def _load_claimed(
    spark: SparkSession, paths: Sequence[str], found: list[Source], chosen: list[Source], known: dict, target: str, import_date: date,
    seq: int, load: str, how: _Reading,
) -> Load:
    staging = f"{target}/_staging-{load}"
    nothing = dict.fromkeys([*COUNTS, "damaged"], 0)
    counts: dict[str, dict[str, int]] = {}
    try:
        filled = [storage.literal(file) for s in chosen if s.length for file in s.files]
        if filled:
            counts = _write_counted(spark, filled, staging, import_date, load, how)
        per_file = {s.file_id: nothing | counts.get(s.file_id, {}) for s in chosen}
        empty = sorted(i for i, n in per_file.items() if not n["rows"])
        wrong = sorted(i for i, n in per_file.items() if n["rows"] + n["damaged"] != n["nonblank_lines"])
        mismatches = "; ".join(f"{i}: {per_file[i]['rows']} rows, {per_file[i]['nonblank_lines']} lines" for i in wrong[:5])
        if how.strict and (empty or not chosen):
            raise EmptyLoad(f"no rows in {', '.join(empty[:5]) or paths}; nothing was replaced")
        if how.strict and wrong:
            raise CountMismatch(mismatches)
        if chosen:
            if len(empty) < len(chosen):
                storage.move_into(spark, f"{day_folder(staging, import_date)}/load={load}", f"{day_folder(target, import_date)}/load={load}")
            register = [(s.file_id, s.name, s.folder, *[per_file[s.file_id][c] for c in COUNTS], seq, load, import_date) for s in chosen]
            write_register(spark.createDataFrame(register, REGISTER_SCHEMA), target, import_date, load)
    finally:
        storage.remove(spark, staging)
    replaced = [known[i] for i in per_file if i in known]
    _remove_old(spark, target, import_date, [r.file_name for r in replaced])
    totals = {c: sum(n[c] for n in per_file.values()) for c in COUNTS}
    return Load(
        _label(paths, chosen), import_date, totals["rows"], sum(r.rows for r in replaced), totals["nonblank_lines"], totals["short_rows"],
        totals["long_rows"], not wrong, len(chosen), len(empty), len(found) - len(chosen), len(wrong), mismatches or None,
        sum(n["damaged"] for n in per_file.values()),
    )


def _remove_old(spark: SparkSession, target: str, import_date: date, ids: Sequence[str]) -> None:
    """Remove what was replaced before; what this load replaced stays for those who are reading it."""
    if not ids:
        return
    old = _of_ids(spark, superseded(spark, target, import_date), ids)
    day = day_folder(target, import_date)
    with ThreadPoolExecutor(storage.THREADS) as pool:
        list(pool.map(lambda r: storage.remove(spark, f"{day}/load={r.load}/file_name={storage.partition_value(spark, r.file_name)}"), old))


def _label(paths: Sequence[str], chosen: list[Source]) -> str:
    """The file id, or how many files there were."""
    return chosen[0].file_id if len(chosen) == 1 else f"{len(chosen)} files"


def ingest(
    spark: SparkSession,
    root: str,
    target: str,
    import_date: date,
    year_prefix: str | None = None,
    file_prefix: str | None = None,
    date_pattern: str = fixed.FILE_DATE_PATTERN,
    parts: bool = False,
    **load_options,
) -> Load:
    """Load the newest file version of the newest day folder, where it lies; with ``parts`` it may be a file in parts."""
    drop = find_latest_drop(spark, root, year_prefix, file_prefix, date_pattern, parts=parts)
    return load_files(spark, [drop.path], target, import_date, parts=drop.in_parts, **load_options)
