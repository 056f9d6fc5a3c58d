"""Every registered query against DuckDB, by value and without order."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from slotmill.plans.showcase import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    def key(row):
        return [(value is None, "nan" if isinstance(value, float) and math.isnan(value) else str(value)) for value in row]

    return sorted((tuple(row) for row in rows), key=key)


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Window ")


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    names = [column[0] for column in expected.description]
    assert sorted(names) == sorted(frame.columns)
    got = ordered(frame.select(names).collect())
    assert got == ordered(expected.fetchall())
    assert got
