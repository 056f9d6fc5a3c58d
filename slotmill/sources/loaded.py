"""The loaded table: loads in folders of their own, and a register that says which of them counts.

``import_date=<day>/load=<load>/file_name=<id>`` holds the rows of one file of one
load. The register below the table has one small file for each load. A load
shows as soon as that file is moved into place, with all of its files and
instead of all that they held before; until then its rows are beside the table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill.operators.newest import newest_by
from slotmill.sources import storage
from slotmill.sources.prelog import PRELOG_SCHEMA

#: below the table in a folder that readers pass over
REGISTER = "_loads"
REGISTER_SCHEMA = (
    "file_name string, source_file string, folder date, rows bigint, nonblank_lines bigint, short_rows bigint, "
    "long_rows bigint, seq bigint, load string, import_date date"
)
_KEY = ["import_date", "file_name"]
_REST = ["source_file", "folder", "rows", "nonblank_lines", "short_rows", "long_rows", "load"]


def day_folder(target: str, import_date: date) -> str:
    return f"{target}/import_date={import_date.isoformat()}"


def register_rows(spark: SparkSession, target: str, import_date: date | None = None) -> DataFrame:
    """Every registration there has been."""
    place = f"{target}/{REGISTER}"
    if not storage.exists(spark, place):
        return spark.createDataFrame([], REGISTER_SCHEMA)
    rows = spark.read.schema(REGISTER_SCHEMA).parquet(place)
    return rows if import_date is None else rows.filter(F.col("import_date") == F.lit(import_date))


def read_register(spark: SparkSession, target: str, import_date: date | None = None) -> DataFrame:
    """The newest registration of each (import date, file id), with the counts of its file."""
    return newest_by(register_rows(spark, target, import_date), _KEY, _REST, ["seq", "load"])


def write_register(rows: DataFrame, target: str, import_date: date, load: str) -> None:
    """Register a load: its rows become one file, which is moved into place in one step."""
    spark, staging = rows.sparkSession, f"{target}/_register-{load}"
    try:
        rows.drop("import_date").coalesce(1).write.parquet(staging)
        part = next(e for e in storage.listing(spark, staging) if e.name.startswith("part-"))
        storage.move_into(spark, part.path, f"{day_folder(f'{target}/{REGISTER}', import_date)}/{load}.parquet")
    finally:
        storage.remove(spark, staging)


def read_loaded(spark: SparkSession, target: str, import_date: date | None = None) -> DataFrame:
    """The loaded table, or only one import day of it so that no other folder is listed.

    A table without a register, partitioned by the load key alone, is read as it is.
    """
    kinds = {f.name: f.dataType.simpleString() for f in PRELOG_SCHEMA.fields}
    registered = storage.exists(spark, f"{target}/{REGISTER}")
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + (", load string" if registered else "")
    place = target if import_date is None else day_folder(target, import_date)
    if import_date is not None and not storage.exists(spark, place):
        return spark.createDataFrame([], PRELOG_SCHEMA)
    rows = spark.read.schema(schema).option("basePath", target).parquet(place)
    if not registered:
        return rows.select(PRELOG_SCHEMA.names)
    live = read_register(spark, target, import_date).filter("rows > 0").select(*_KEY, "load")
    return rows.join(live, [*_KEY, "load"], "left_semi").select(PRELOG_SCHEMA.names)


def superseded(spark: SparkSession, target: str, import_date: date, keep: int = 1) -> DataFrame:
    """(file_name, load) of a day's files that later loads replaced, but for the last ``keep`` of each."""
    rows = register_rows(spark, target, import_date)
    newest_first = F.sort_array(F.collect_list(F.struct("seq", "load", "rows")), asc=False)
    old = rows.groupBy("file_name").agg(F.slice(newest_first, 2 + keep, F.greatest(F.count("*"), F.lit(1)).cast("int")).alias("old"))
    return old.select("file_name", F.inline("old")).filter("rows > 0").select("file_name", "load")
