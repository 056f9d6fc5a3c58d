"""The weekly run: load, report, export, record."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import SparkSession

from slotmill import fixed
from slotmill.errors import MissingInput
from slotmill.operators.retype import retype_date_columns
from slotmill.operators.titles import exclusive_titles
from slotmill.plans.audit import ERROR, SUCCESS, WARNING, record_run
from slotmill.plans.ingest import Load, ingest
from slotmill.plans.report import ReportSpec, export_checked, export_datasets, run_report, secondary_spec
from slotmill.sources.loaded import read_loaded


def weekly_reports(
    spark: SparkSession, load: Load, target: str, out: str, specs: Sequence[ReportSpec] | None = None, list_faults: bool = False
) -> dict[str, str]:
    """Write every report of the load and the title list; returns the folder of each dataset.

    Reports of the caller's see the whole table as ``prelog``; the built-in one, which is written
    beside them, lists only its import day. A bad cell fails the run; with ``list_faults`` all of them
    are written as a dataset beside each report first.
    """
    args = {"file_name": load.file_name, "import_date": load.import_date}
    built_in = secondary_spec(load.file_name)
    frames = {built_in: read_loaded(spark, target, load.import_date)}
    if specs:
        frames.update(dict.fromkeys(specs, read_loaded(spark, target)))
    titles = {fixed.TITLE_DATASET: exclusive_titles(spark)}
    reports = {
        spec: retype_date_columns(run_report(spark, spec, args, {"prelog": frame}, not list_faults), spec.date_columns)
        for spec, frame in frames.items()
    }
    if list_faults:
        return export_datasets(titles, out) | export_checked(reports, out)
    return export_datasets({spec.name: report for spec, report in reports.items()} | titles, out)


def weekly_run(
    spark: SparkSession,
    root: str,
    target: str,
    out: str,
    audit: str,
    import_date: date,
    specs: Sequence[ReportSpec] | Callable[[Load], Sequence[ReportSpec]] | None = None,
    list_faults: bool = False,
    **ingest_options,
) -> str:
    """Run once and record the outcome, which is also returned.

    A missing input file is a warning. Any other failure is recorded and raised.
    """
    load = None
    try:
        load = ingest(spark, root, target, import_date, **ingest_options)
        weekly_reports(spark, load, target, out, specs(load) if callable(specs) else specs, list_faults)
    except MissingInput as missing:
        record_run(spark, audit, import_date, WARNING, message=str(missing))
        return WARNING
    except Exception as error:
        record_run(spark, audit, import_date, ERROR, load, str(error))
        raise
    record_run(spark, audit, import_date, SUCCESS, load)
    return SUCCESS
