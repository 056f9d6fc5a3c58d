"""Task log kept as versions: an update is a newer row of the same ``log_id``."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.errors import UnknownLogId
from slotmill.operators.newest import newest_by
from slotmill.operators.rows import one_row
from slotmill.operators.sizing import gather_by
from slotmill.sources import storage

VERSION_SCHEMA = (
    "log_id string, log_task_id int, status_flag int, log_msg string, event_ts timestamp, seq bigint"
)
LOG_SCHEMA = f"{VERSION_SCHEMA}, event_date date"
STATUS_COLUMNS = ["log_task_id", "status_flag", "event_ts", "seq"]


def append_versions(versions: DataFrame, path: str, gather: bool = False) -> None:
    """Append log rows, stored by day. ``gather`` brings the days of a large frame together first."""
    dated = versions.withColumn("event_date", F.to_date("event_ts"))
    rows = gather_by(dated, ["event_date"]) if gather else dated
    rows.write.mode("append").partitionBy("event_date").parquet(path)


def _append_one(
    spark: SparkSession, path: str, log_id: str, log_task_id: int, status_flag: int, log_msg: str, event_ts: datetime, after: int = 0
) -> None:
    version = {
        "log_id": log_id,
        "log_task_id": log_task_id,
        "status_flag": status_flag,
        "log_msg": log_msg,
        "event_ts": event_ts,
        "seq": max(time.time_ns(), after + 1),
    }
    append_versions(one_row(spark, VERSION_SCHEMA, version), path)


def _day_of(log_id: str) -> date | None:
    """The day that ``append_log`` put in front of an id; None for an id from elsewhere."""
    try:
        return datetime.strptime(log_id[:9], "%Y%m%d-").date()
    except ValueError:
        return None


def versions_of(log: DataFrame, log_id: str, *days: date) -> DataFrame:
    """Versions of an id. An id that carries its day needs only the folders of that day and of ``days``.

    Folder dates follow the writer's time zone, so a day more on each side is looked at.
    """
    own = _day_of(log_id)
    if own is not None:
        near = sorted({day + timedelta(days=n) for day in (own, *days) for n in (-1, 0, 1)})
        log = log.filter(F.col("event_date").isin(near))
    return log.filter(F.col("log_id") == log_id)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def append_log(
    spark: SparkSession, path: str, log_task_id: int, status_flag: int, log_msg: str, event_ts: datetime | None = None
) -> tuple[int, str]:
    """Add a row; returns the fixed status 1 and the new id, to be handed to ``update_log``."""
    at = event_ts or datetime.now(timezone.utc)
    log_id = f"{at:%Y%m%d}-{uuid.uuid4()}"
    _append_one(spark, path, log_id, log_task_id, status_flag, log_msg, at)
    return fixed.INSERT_RETURN_STATUS, log_id


def update_log(
    spark: SparkSession,
    path: str,
    log_id: str | None,
    log_task_id: int,
    status_flag: int,
    log_msg: str,
    event_ts: datetime | None = None,
) -> None:
    """New status and message for an existing id, whatever time they carry."""
    if log_id is None:
        raise ValueError("log_id is missing")
    at = event_ts or datetime.now(timezone.utc)
    last = versions_of(read_log(spark, path), log_id, at.date()).agg(F.max("seq")).first()[0]
    if last is None:
        raise UnknownLogId(log_id)
    _append_one(spark, path, log_id, log_task_id, status_flag, log_msg, at, after=last)


def current_log(log: DataFrame) -> DataFrame:
    """One row per ``log_id``: the version that was written last."""
    return newest_by(
        log, ["log_id"], ["log_task_id", "status_flag", "log_msg", "event_ts"], ["seq", "event_ts"]
    )


def merge_files(spark: SparkSession, path: str, day: date, files: int = 1) -> None:
    """Rewrite the folder of one day as ``files`` files, with the same rows.

    Appends of single rows leave a file each. Nobody may append to the day meanwhile: run it for days
    that are over.
    """
    folder, staging = f"event_date={day.isoformat()}", f"{path}/_merge-{uuid.uuid4().hex}"
    if not storage.exists(spark, f"{path}/{folder}"):
        return
    rows = spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/{folder}")
    try:
        rows.repartition(files).write.parquet(f"{staging}/{folder}")
        storage.replace_folders(spark, staging, path, [folder])
    finally:
        storage.remove(spark, staging)


def current_of(log: DataFrame, kept: DataFrame) -> DataFrame:
    """Current versions of the ids that ``kept``, a selection of ``log``, has rows of.

    The rest of the log is only searched for those ids, which reads no messages and moves no rows that
    belong to other ids. Rows without an id have no other versions.
    """
    ids = kept.select("log_id").distinct()
    alone = kept.filter(F.col("log_id").isNull()).select("log_id", *STATUS_COLUMNS)
    return alone.unionByName(newest_by(log.join(ids, "log_id", "left_semi"), ["log_id"], STATUS_COLUMNS, ["seq", "event_ts"]))


def latest_status(log: DataFrame, ref_date: date, as_of: bool = False, task_ids: Sequence[int] | None = None) -> DataFrame:
    """Newest status of each task on ``ref_date``, or up to the end of it with ``as_of``.

    A log with a ``log_id`` holds versions of rows, and only the current version of a row counts, with
    the day and the task that it carries. The day is a range on ``event_ts``, which reaches the file
    statistics. On a log stored by ``event_date`` folders are pruned too, a day wider on each side because
    folder dates follow the writer's time zone; the versions of the rows found there are looked up in
    the other days.
    """
    day = timedelta(days=1)

    def of_day(rows: DataFrame) -> DataFrame:
        kept = rows.filter(F.col("event_ts") < F.lit(ref_date + day))
        if "event_date" in rows.columns:
            kept = kept.filter(F.col("event_date") <= F.lit(ref_date + day))
        if not as_of:
            kept = kept.filter(F.col("event_ts") >= F.lit(ref_date))
            if "event_date" in rows.columns:
                kept = kept.filter(F.col("event_date") >= F.lit(ref_date - day))
        return kept if task_ids is None else kept.filter(F.col("log_task_id").isin(list(task_ids)))

    kept = of_day(log)
    if "log_id" in log.columns:
        kept = of_day(current_of(log, kept))
    newest = F.max_by("status_flag", F.struct("event_ts", "seq"))
    return kept.groupBy("log_task_id").agg(newest.alias("status"))


def status_spans(log: DataFrame, as_of: bool = False) -> DataFrame:
    """(log_task_id, status, since, until): the days over which a task's latest status holds, the last one excluded.

    With ``as_of`` a status holds until the day of the next, and the last one has no ``until``; without,
    it holds on its own day. Only current versions count. A task's days are gathered in one list,
    which a calendar bounds.
    """
    rows = current_of(log, log) if "log_id" in log.columns else log
    newest = F.max_by("status_flag", F.struct("event_ts", "seq")).alias("status")
    days = rows.filter(F.col("event_ts").isNotNull()).groupBy("log_task_id", F.to_date("event_ts").alias("since")).agg(newest)
    if not as_of:
        return days.select("log_task_id", "status", "since", F.date_add("since", 1).alias("until"))
    listed = days.groupBy("log_task_id").agg(F.sort_array(F.collect_list(F.struct("since", "status"))).alias("days"))
    spans = F.transform("days", lambda d, i: F.struct(d["status"].alias("status"), d["since"].alias("since"), F.get("days", i + 1)["since"].alias("until")))
    return listed.select("log_task_id", F.inline(spans))
