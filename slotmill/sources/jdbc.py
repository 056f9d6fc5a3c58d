"""Database tables over JDBC.

Spark cannot delete by key over JDBC, so a keyed replace is two steps: the rows
go to a staging table here, and the database swaps them in one transaction.
``existing_rows(read_table(...), file_name=..., import_date=...)`` counts the
rows that the swap will take away.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password}
        known = {key: value for key, value in login.items() if value is not None}
        return {"url": self.url, "driver": self.driver, **known, **self.properties}


@dataclass(frozen=True)
class Split:
    """A numeric, date or timestamp column that cuts a read into parallel ranges."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


#: stands in place of a split where one task may read the whole result
ONE_TASK = "one task"


def query_options(database: Database, query: str, split: Split | str, fetch_size: int = 10_000) -> dict[str, str]:
    options = {**database.options(), "fetchsize": str(fetch_size)}
    if split == ONE_TASK:
        return {**options, "query": query}
    # ranges only work on a table expression
    return {**options, **split.options(), "dbtable": f"({query}) q"}


def read_query(
    spark: SparkSession, database: Database, query: str, split: Split | str, fetch_size: int = 10_000
) -> DataFrame:
    """A query as a DataFrame, read in the ranges of ``split``, or alone with ``ONE_TASK``."""
    return spark.read.format("jdbc").options(**query_options(database, query, split, fetch_size)).load()


def read_rows(spark: SparkSession, database: Database, query: str, fetch_size: int = 10_000) -> Iterator[Row]:
    """All rows of a query, in its order, a partition at a time; meant for results that one task can read."""
    return read_query(spark, database, query, ONE_TASK, fetch_size).toLocalIterator()


def read_table(spark: SparkSession, database: Database, table: str, split: Split | str) -> DataFrame:
    """A whole table, read like a query; filters on it are passed on to the database."""
    options = {**database.options(), "dbtable": table, **({} if split == ONE_TASK else split.options())}
    return spark.read.format("jdbc").options(**options).load()


def write_options(database: Database, table: str, connections: int = 8, batch_size: int = 10_000) -> dict[str, str]:
    return {
        **database.options(),
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def narrowed(df: DataFrame, connections: int) -> DataFrame:
    """Rows in as many partitions as connections, by a shuffle, so that what comes before keeps all its tasks."""
    return df.repartition(connections)


def append_table(df: DataFrame, database: Database, table: str, connections: int = 8, batch_size: int = 10_000) -> None:
    """Append rows. A failed job may leave rows of finished tasks behind."""
    narrowed(df, connections).write.format("jdbc").options(**write_options(database, table, connections, batch_size)).mode("append").save()


def fill_staging(df: DataFrame, database: Database, table: str, connections: int = 8, batch_size: int = 10_000) -> None:
    """Empty the staging table and fill it, so that a repeated job starts clean."""
    options = {**write_options(database, table, connections, batch_size), "truncate": "true"}
    narrowed(df, connections).write.format("jdbc").options(**options).mode("overwrite").save()
