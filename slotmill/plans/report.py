"""Parameterised reports: SQL from the caller, column clean-up from a ``ReportSpec``.

The clean-up is one projection on top of the query, in the order sentinel,
dates, integers, lenient numbers; nothing passes through the driver. A checked
report goes on over bad cells and lists them all.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotmill import fixed
from slotmill.errors import BadCells
from slotmill.functions.dates import display_date, strict_date
from slotmill.functions.names import quoted
from slotmill.functions.numbers import lenient_double, lenient_number, lenient_text, strict_int, whole_number
from slotmill.functions.text import null_text
from slotmill.sources import storage
from slotmill.sources.loaded import read_loaded
from slotmill.sources.sql import query_table

NUMBER_SUFFIX, DOUBLE_SUFFIX = "_NUMBER", "_DOUBLE"
#: columns that a checked report has beside its own: the faults of a row, and its key as the query gave it
FAULTS, KEY_PREFIX = "_faults", "_key_"


@dataclass(frozen=True)
class ReportSpec:
    """One report dataset.

    ``on_null`` says what a null in a date or integer column does: ``fail`` the
    job, or ``keep`` the null. ``key_columns`` name a row where its faults are listed.
    """

    name: str
    sql: str
    date_columns: tuple[str, ...] = ()
    int_columns: tuple[str, ...] = ()
    lenient_columns: tuple[str, ...] = ()
    on_null: str = "fail"
    key_columns: tuple[str, ...] = ()

    def __post_init__(self):
        if self.on_null not in ("fail", "keep"):
            raise ValueError(f"on_null must be fail or keep, not {self.on_null!r}")


def _typed(field: T.StructField, spec: ReportSpec) -> tuple[Column, str] | None:
    """A date or integer column's value, null where it is none, and what is said of such a value."""
    value = F.col(quoted(field.name))
    if field.name in spec.date_columns:
        return value.try_cast("date"), "not a date"
    if field.name in spec.int_columns:
        return whole_number(value, field.dataType), "not a whole number"
    return None


def _cleaned(field: T.StructField, spec: ReportSpec, strict: bool = True) -> list[Column]:
    name, value = field.name, F.col(quoted(field.name))
    null_fails = spec.on_null == "fail"
    if name in spec.date_columns:
        day = strict_date(value, label=f"date in {name}", null_fails=null_fails) if strict else value.try_cast("date")
        return [display_date(day).alias(name)]
    if name in spec.int_columns:
        number = strict_int(value, field.dataType, name, null_fails) if strict else whole_number(value, field.dataType)
        return [number.alias(name)]
    if isinstance(field.dataType, T.StringType):
        value = null_text(value)
    if name in spec.lenient_columns:
        text = value.cast("string")
        return [
            lenient_text(text).alias(name),
            lenient_number(text).alias(name + NUMBER_SUFFIX),
            lenient_double(text).alias(name + DOUBLE_SUFFIX),
        ]
    return [value.alias(name)]


def _check_columns(df: DataFrame, spec: ReportSpec) -> None:
    named = spec.date_columns + spec.int_columns + spec.lenient_columns + spec.key_columns
    unknown = [name for name in named if name not in df.columns]
    if unknown:
        raise ValueError(f"{spec.name} has no column {', '.join(unknown)}")


def clean_report(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Text nulls as sentinel, dates as display text, integers as bigint, mixed columns as text, integer and number."""
    _check_columns(df, spec)
    return df.select(*[column for field in df.schema.fields for column in _cleaned(field, spec)])


def checked_report(df: DataFrame, spec: ReportSpec, faults: str = FAULTS) -> DataFrame:
    """``clean_report`` that fails on nothing: bad cells become null and are listed in the column ``faults``.

    An array of (column, value, reason), empty for a sound row. A null counts as a fault where
    ``spec.on_null`` is ``fail``.
    """
    _check_columns(df, spec)
    found = []
    for field in df.schema.fields:
        typed = _typed(field, spec)
        if typed:
            value, (parsed, reason) = F.col(quoted(field.name)), typed
            bad = parsed.isNull() & (F.lit(True) if spec.on_null == "fail" else value.isNotNull())
            why = F.when(value.isNull(), "null").otherwise(reason)
            fault = F.struct(F.lit(field.name).alias("column"), value.cast("string").alias("value"), why.alias("reason"))
            found.append(F.when(bad, fault))
    none = F.array().cast("array<struct<column:string,value:string,reason:string>>")
    listed = F.filter(F.array(*found), lambda fault: fault.isNotNull()) if found else none
    keys = [F.col(quoted(key)).alias(f"{KEY_PREFIX}{key}") for key in spec.key_columns]
    return df.select(*[column for field in df.schema.fields for column in _cleaned(field, spec, False)], *keys, listed.alias(faults))


def report_faults(checked: DataFrame, spec: ReportSpec, faults: str = FAULTS) -> DataFrame:
    """(*key columns, column, value, reason): one row for each bad cell; the keys as they were before the clean-up."""
    keys = [F.col(quoted(f"{KEY_PREFIX}{key}")).alias(key) for key in spec.key_columns]
    return checked.select(*keys, F.inline(faults))


def export_checked(checked: Mapping[ReportSpec, DataFrame], out: str, on_fault: str = "raise") -> dict[str, str]:
    """Write each checked report and its faults, under its name and its name with `` faults``; returns all folders.

    The query runs once: what it gave is written down and both datasets are made of that. With ``raise``
    a fault in any report raises ``BadCells`` after all of them are written, with ``keep`` it does not.
    """
    if on_fault not in ("raise", "keep"):
        raise ValueError(f"on_fault must be raise or keep, not {on_fault!r}")
    folders, bad = {}, []
    for spec, df in checked.items():
        staging = f"{out.rstrip('/')}/_checked-{uuid.uuid4().hex}"
        try:
            df.write.parquet(staging)
            stored = df.sparkSession.read.schema(df.schema).parquet(staging)
            faults = report_faults(stored, spec)
            rows = stored.select(*[F.col(quoted(c)) for c in stored.columns if c != FAULTS and not c.startswith(KEY_PREFIX)])
            folders |= export_datasets({spec.name: rows, f"{spec.name} faults": faults}, out)
            count = faults.count()
        finally:
            storage.remove(df.sparkSession, staging)
        if count:
            bad.append(f"{count} bad cells in {spec.name}")
    if bad and on_fault == "raise":
        raise BadCells(f"{'; '.join(bad)}; listed in {out}")
    return folders


def run_report(
    spark: SparkSession,
    spec: ReportSpec,
    args: Mapping[str, object],
    tables: Mapping[str, DataFrame] | None = None,
    strict: bool = True,
) -> DataFrame:
    """The cleaned report; without ``strict`` with its faults listed, for ``export_checked``."""
    clean = clean_report if strict else checked_report
    return clean(query_table(spark, spec.sql, args, tables), spec)


def secondary_spec(file_id: str) -> ReportSpec:
    """Example: the load as it is, under its file id. Callers bring their own main report."""
    return ReportSpec(
        name=file_id,
        sql="SELECT * FROM prelog WHERE file_name = :file_name AND import_date = :import_date",
        date_columns=fixed.SECONDARY_DATE_COLUMNS,
        int_columns=fixed.SECONDARY_INT_COLUMNS,
        lenient_columns=fixed.SECONDARY_LENIENT_COLUMNS,
    )


def main_spec(sql: str) -> ReportSpec:
    """The main dataset's columns around a query of the caller's."""
    return ReportSpec(
        name=fixed.MAIN_DATASET,
        sql=sql,
        date_columns=fixed.MAIN_DATE_COLUMNS,
        int_columns=fixed.MAIN_INT_COLUMNS,
    )


def register_loaded(
    spark: SparkSession, target: str, import_date: date | None = None, view: str = "prelog"
) -> DataFrame:
    """The loaded table as a view; with ``import_date`` only that day's folders are listed."""
    table = read_loaded(spark, target, import_date)
    table.createOrReplaceTempView(view)
    return table


def export_datasets(datasets: Mapping[str, DataFrame], out: str, fmt: str = "parquet", **options) -> dict[str, str]:
    """One folder per dataset below ``out``; each job commits on its own and can be repeated."""
    folders = {}
    for name, df in datasets.items():
        folders[name] = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).options(**options).save(folders[name])
    return folders
