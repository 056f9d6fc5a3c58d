"""One row per run: success, warning (no input file) or error (anything else)."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from slotmill.operators.newest import newest_by
from slotmill.operators.rows import one_row
from slotmill.plans.ingest import Load

SUCCESS, WARNING, ERROR = "success", "warning", "error"

AUDIT_SCHEMA = (
    "run_id string, run_ts timestamp, file_name string, import_date date, outcome string, loaded_rows bigint, "
    "replaced_rows bigint, nonblank_lines bigint, short_rows bigint, long_rows bigint, matched boolean, "
    "empty_files bigint, skipped_files bigint, mismatched_files bigint, mismatches string, batch_id bigint, message string"
)
_OF_LOAD = (
    "file_name", "loaded_rows", "replaced_rows", "nonblank_lines", "short_rows", "long_rows", "matched", "empty_files", "skipped_files",
    "mismatched_files", "mismatches",
)


def record_run(
    spark: SparkSession,
    path: str,
    import_date: date,
    outcome: str,
    load: Load | None = None,
    message: str | None = None,
    run_id: str | None = None,
    batch_id: int | None = None,
) -> str:
    """Append the outcome; returns the run id. A run that is repeated under one id counts once, by its last record."""
    run = {
        "run_id": run_id or str(uuid.uuid4()),
        "run_ts": datetime.now(timezone.utc),
        "import_date": import_date,
        "outcome": outcome,
        "message": message,
        "batch_id": batch_id,
    }
    if load:
        run.update((name, getattr(load, name)) for name in _OF_LOAD)
    one_row(spark, AUDIT_SCHEMA, run).write.mode("append").parquet(path)
    return run["run_id"]


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    rest = [c for c in rows.columns if c not in ("run_id", "run_ts")]
    return newest_by(rows, ["run_id"], ["run_ts", *rest], ["run_ts"]).select(rows.columns)
