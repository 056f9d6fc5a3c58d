"""SQL text in, DataFrame or rows out. Values are bound, never spliced into the text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession

from slotmill.functions.names import quoted


def query_table(
    spark: SparkSession,
    sql: str,
    args: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run a query with ``:name`` markers over registered views and the given ``tables``.

    The tables are names of this query alone: views of the session are neither replaced nor added.
    """
    views = {name: f"slotmill_{uuid.uuid4().hex}" for name in tables or {}}
    try:
        for name, view in views.items():
            tables[name].createOrReplaceTempView(view)
        named = ", ".join(f"{quoted(name)} AS (SELECT * FROM {view})" for name, view in views.items())
        # the newline ends a comment in the query's last line
        return spark.sql(f"WITH {named} SELECT * FROM ({sql.strip().rstrip(';')}\n)" if views else sql, args=dict(args or {}))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def query_rows(
    spark: SparkSession,
    sql: str,
    args: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> Iterator[Row]:
    """All rows of a result, one partition in the driver's memory at a time."""
    return query_table(spark, sql, args, tables).toLocalIterator()
