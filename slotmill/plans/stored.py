"""Reports stored by name as SQL table functions with typed parameters.

A stored report is called like a table, by name or in the middle of other SQL.
Spark puts its query in the place of the call, so filters and columns reach the
scans as if the query had been written there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from slotmill.functions.names import quoted
from slotmill.plans.report import ReportSpec, checked_report, clean_report


@dataclass(frozen=True)
class Parameter:
    """A typed parameter; ``default`` is an SQL expression, and without one the caller has to give a value."""

    name: str
    kind: str
    default: str | None = None

    def ddl(self) -> str:
        return f"{quoted(self.name)} {self.kind}" + (f" DEFAULT {self.default}" if self.default is not None else "")


def store_report(spark: SparkSession, name: str, sql: str, parameters: tuple[Parameter, ...] = (), temporary: bool = True) -> None:
    """Store a query under a name, in place of an earlier one of that name.

    In the query a parameter is written as its name, or ``<report>.<parameter>`` where a column has the
    same one. A temporary report is the session's and may read its views; a lasting one is the
    catalog's and reads tables.
    """
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    listed = ", ".join(p.ddl() for p in parameters)
    spark.sql(f"CREATE OR REPLACE {kind} {quoted(name)}({listed}) RETURNS TABLE RETURN {sql.strip().rstrip(';')}")


def drop_report(spark: SparkSession, name: str, temporary: bool = True) -> None:
    spark.sql(f"DROP {'TEMPORARY ' * temporary}FUNCTION IF EXISTS {quoted(name)}")


def call_report(spark: SparkSession, name: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """What the stored query gives for the arguments, which are bound by parameter name and cast to its type."""
    given = dict(args or {})
    marks = ", ".join(f"{quoted(key)} => :{key}" for key in given)
    return spark.sql(f"SELECT * FROM {quoted(name)}({marks})", args=given)


def run_stored(
    spark: SparkSession, name: str, spec: ReportSpec, args: Mapping[str, object] | None = None, strict: bool = True
) -> DataFrame:
    """A stored report with the clean-up of ``spec``, whose own query is not used; like ``run_report`` otherwise."""
    return (clean_report if strict else checked_report)(call_report(spark, name, args), spec)
