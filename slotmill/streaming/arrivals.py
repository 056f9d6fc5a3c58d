"""Incremental ingest of drop files.

A drop may be corrected, emptied and filled again under its name, so what arrives
is a version of a file: its path, time and length. A start lists the landing
area, compares it with the versions that were noted before, and notes the new
ones in small files of their own. Those notes, which never change, are the
source of the stream. Each micro-batch is a bounded list of paths, and the batch
load reads those files once, with the same plan as a scheduled run. The table's
register says from which day folder a file was loaded, so the result does not
depend on how arrivals fall into batches. A batch that is repeated after a
failure replaces its own rows and its own run record.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from datetime import date
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotmill.functions.names import base_name, parent_name
from slotmill.plans.audit import SUCCESS, record_run
from slotmill.plans.ingest import load_files
from slotmill.sources import storage
from slotmill.sources.landing import candidate_files, day_folders, landing_entries

ARRIVAL_SCHEMA = "path string, modified bigint, length bigint"
#: versions of files, in folders below the checkpoint
NOTES, LISTED = "arrivals", "listed"
#: entries of the landing area that the driver holds at a time
LISTED_AT_ONCE = 100_000


def file_versions(spark: SparkSession, root: str, year_prefix: str | None = None) -> Iterator[tuple[str, int, int]]:
    """(path, modified, length) of the files in day folders below ``root``, those of zero bytes too; folder by folder."""
    for row in day_folders(landing_entries(spark, root), year_prefix).toLocalIterator():
        for entry in storage.listing(spark, f"{root.rstrip('/')}/{row.folder}"):
            if not entry.is_folder and not entry.name.startswith(("_", ".")):
                yield entry.path, entry.modified, entry.length


def _write_listing(spark: SparkSession, versions: Iterable[tuple[str, int, int]], place: str) -> DataFrame:
    """The listing as a table, written in parts so that the driver holds few of its rows."""
    rows, written = iter(versions), False
    while part := list(islice(rows, LISTED_AT_ONCE)):
        spark.createDataFrame(part, ARRIVAL_SCHEMA).write.mode("append").parquet(place)
        written = True
    return spark.read.schema(ARRIVAL_SCHEMA).parquet(place) if written else spark.createDataFrame([], ARRIVAL_SCHEMA)


def note_arrivals(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    year_prefix: str | None = None,
    file_prefix: str | None = None,
    files_per_batch: int = 1000,
) -> str:
    """Note the file versions that are there now and were not noted before; returns the folder of all notes.

    A note is one Parquet file of at most ``files_per_batch`` versions. A note that was written although the
    rest failed stands, and the next start notes the rest. Two versions of a file that agree in time
    and length are taken for one.
    """
    notes, listed = f"{checkpoint.rstrip('/')}/{NOTES}", f"{checkpoint.rstrip('/')}/{LISTED}"
    storage.make_folder(spark, notes)
    storage.remove(spark, listed)
    try:
        found = _write_listing(spark, file_versions(spark, root, year_prefix), listed)
        named = candidate_files(found.withColumn("file", base_name(F.col("path"))), file_prefix).drop("file")
        known = spark.read.schema(ARRIVAL_SCHEMA).parquet(notes)
        new = named.join(known, ["path", "modified", "length"], "left_anti")
        count = new.count()
        if count:
            # a note holds neighbours; the result does not depend on it
            parts = new.repartitionByRange(-(-count // files_per_batch), F.desc(parent_name(F.col("path"))), "path")
            parts.write.mode("append").option("maxRecordsPerFile", files_per_batch).parquet(notes)
    finally:
        storage.remove(spark, listed)
    return notes


def arrivals(spark: SparkSession, notes: str) -> DataFrame:
    """Stream of noted file versions, one note a batch."""
    return spark.readStream.schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(notes)


def start_ingest(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    import_date: date,
    year_prefix: str | None = None,
    file_prefix: str | None = None,
    files_per_batch: int = 1000,
    audit: str | None = None,
    **load_options,
) -> StreamingQuery:
    """Load everything that arrived or changed since the last run over the same checkpoint, then stop.

    Copies of one name in several day folders count once, newest folder first, in whatever batches they
    come. A file that is gone again by the time its batch runs is passed over. With ``audit`` every batch
    leaves one run record, however often it is repeated.
    """
    options = {"skip_older": True, "missing": "skip", **load_options}
    notes = note_arrivals(spark, root, checkpoint, year_prefix, file_prefix, files_per_batch)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # at most files_per_batch paths
        paths = sorted({row.path for row in batch.select("path").collect()})
        if not paths:
            return
        run = f"stream-{stream}-{batch_id}"
        load = load_files(batch.sparkSession, paths, target, import_date, owner=run, **options)
        if audit:
            record_run(batch.sparkSession, audit, import_date, SUCCESS, load, run_id=run, batch_id=batch_id)

    return (
        arrivals(spark, notes)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
        .trigger(availableNow=True)
        .start()
    )
