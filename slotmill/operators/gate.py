"""Prerequisite gate: every task's latest status must be one of its allowed ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.errors import BadRequirement
from slotmill.functions.dates import as_day
from slotmill.operators.runlog import latest_status, status_spans

PREREQUISITE_SCHEMA = "name string, log_task_id int, allowed_status array<int>"


def prerequisite_frame(spark: SparkSession, prerequisites: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Frame from ``{name: {"log_task_id": 88, "allowed_status": [1, 3]}}``; absent fields become null."""
    rows = [(name, p.get("log_task_id"), p.get("allowed_status")) for name, p in prerequisites.items()]
    return spark.createDataFrame(rows, PREREQUISITE_SCHEMA)


def _faults() -> tuple[Column, Column, Column]:
    """No task id; no allowed statuses; allowed statuses that are not known."""
    known = F.array(*[F.lit(code) for code in fixed.STATUS_CODES])
    return (
        F.col("log_task_id").isNull(),
        F.col("allowed_status").isNull(),
        F.array_except("allowed_status", known),
    )


def missing_fields(prerequisites: DataFrame) -> DataFrame:
    """Prerequisites without a task id or a list of allowed statuses."""
    task, allowed, _ = _faults()
    return prerequisites.filter(task | allowed).select(
        "name", task.alias("no_task_id"), allowed.alias("no_allowed_status")
    )


def invalid_allowed(prerequisites: DataFrame) -> DataFrame:
    """Prerequisites that allow a status outside the known codes, with those statuses."""
    *_, invalid = _faults()
    return prerequisites.withColumn("invalid", invalid).filter(F.size("invalid") > 0)


def check_prerequisites(prerequisites: DataFrame) -> None:
    """Raise with some of the offending names."""
    task, allowed, invalid = _faults()
    faults = prerequisites.select("name", (task | allowed).alias("missing"), invalid.alias("invalid"))
    found = faults.filter("missing OR size(invalid) > 0").take(5)
    if found:
        raise BadRequirement(
            "; ".join(f"{f.name} lacks a field" if f.missing else f"{f.name} allows {f.invalid}" for f in found)
        )


def gate_rows(prerequisites: DataFrame, statuses: DataFrame) -> DataFrame:
    """Each prerequisite with its latest status (-1 when the task has none) and whether it passed.

    One without a task id or a list of allowed statuses never passes, and a null in a list allows nothing.
    """
    status = F.coalesce("status", F.lit(fixed.STATUS_WHEN_ABSENT))
    allowed = F.coalesce(F.array_contains("allowed_status", F.col("status")), F.lit(False))
    return (
        prerequisites.join(statuses, "log_task_id", "left")
        .withColumn("status", status)
        .withColumn("passed", allowed & F.col("log_task_id").isNotNull())
    )


def gate_total(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All passed, per group; over no rows at all the gate is open."""
    return rows.groupBy(*by).agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))


def task_gate(log: DataFrame, prerequisites: DataFrame, ref_date: date, as_of: bool = False) -> DataFrame:
    """One row for a whole set of tasks. The log is reduced to one row per task before it meets them."""
    return gate_total(gate_rows(prerequisites, latest_status(log, ref_date, as_of)))


def tasks_passed(
    spark: SparkSession,
    log: DataFrame,
    ref_date: date | str,
    prerequisites: Mapping[str, Mapping[str, object]],
    as_of: bool = False,
) -> bool:
    """The gate for named tasks; their ids are part of the filter on the day's rows, so they reach its scan."""
    frame = prerequisite_frame(spark, prerequisites)
    check_prerequisites(frame)
    task_ids = sorted({p["log_task_id"] for p in prerequisites.values()})
    statuses = latest_status(log, as_day(ref_date), as_of, task_ids)
    # at most one row per named task
    return gate_total(gate_rows(frame, F.broadcast(statuses))).first().passed


def gate_calendar(
    log: DataFrame, prerequisites: DataFrame, references: DataFrame, by: Sequence[str] = (), as_of: bool = False
) -> DataFrame:
    """(*by, ref_date, tasks, passing, passed): the gate of each set of prerequisites on many days at once.

    ``references`` holds (*by, ref_date) in any number of rows; null days are left out, and a set without
    prerequisites is open. A task's statuses become spans of days, and a span changes the number of
    passing tasks on its first day and back on its last. So neither tasks nor log rows are repeated for
    each day: a set comes down to its changes by day, which a calendar bounds, and a day adds up those
    before it.
    """
    status = F.lit(fixed.STATUS_WHEN_ABSENT)
    listed = F.col("log_task_id").isNotNull() & F.col("allowed_status").isNotNull()
    absent = F.coalesce(listed & F.array_contains("allowed_status", status), F.lit(False)).cast("int")
    tasks = prerequisites.select(*by, "log_task_id", "allowed_status", absent.alias("absent"))
    allowed = F.coalesce(F.array_contains("allowed_status", F.col("status")), F.lit(False)).cast("int")
    spans = tasks.join(status_spans(log, as_of), "log_task_id").withColumn("change", allowed - F.col("absent"))
    ends = F.array(
        F.struct(F.col("since").alias("day"), F.col("change").alias("change")),
        F.struct(F.col("until").alias("day"), (-F.col("change")).alias("change")),
    )
    changes = spans.filter("change <> 0").select(*by, F.inline(ends)).filter(F.col("day").isNotNull())
    changes = changes.groupBy(*by, "day").agg(F.sum("change").alias("change"))

    none = F.lit(None)
    marks = (
        changes.select(*by, "day", "change", none.cast("date").alias("ref_date"), none.cast("long").alias("tasks"), none.cast("long").alias("absent"))
        .unionByName(
            tasks.groupBy(*by)
            .agg(F.count("*").alias("tasks"), F.coalesce(F.sum("absent"), F.lit(0)).alias("absent"))
            .select(*by, none.cast("date").alias("day"), none.cast("long").alias("change"), none.cast("date").alias("ref_date"), "tasks", "absent")
        )
        .unionByName(
            references.select(*by, "ref_date").filter(F.col("ref_date").isNotNull()).distinct()
            .select(*by, none.cast("date").alias("day"), none.cast("long").alias("change"), "ref_date", none.cast("long").alias("tasks"), none.cast("long").alias("absent"))
        )
    )
    sets = marks.groupBy(*by).agg(
        F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "change"))).alias("changes"),
        F.collect_list("ref_date").alias("days"),
        F.coalesce(F.sum("tasks"), F.lit(0)).alias("tasks"),
        F.coalesce(F.sum("absent"), F.lit(0)).alias("absent"),
    )
    before = F.filter("changes", lambda c: c["day"] <= F.col("ref_date"))
    passing = F.aggregate(before, F.col("absent"), lambda n, c: n + c["change"])
    dated = sets.select(*by, "changes", "tasks", "absent", F.explode("days").alias("ref_date"))
    counted = dated.select(*by, "ref_date", "tasks", passing.alias("passing"))
    return counted.withColumn("passed", F.col("passing") == F.col("tasks"))
