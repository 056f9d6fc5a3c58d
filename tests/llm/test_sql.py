"""The queries that SQL can express against DuckDB, by value and without order."""

from pathlib import Path

import duckdb
import pytest

from slotmill.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = connection.execute(ORACLE_SQL[name])
    names = [column[0] for column in expected.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(frame.columns)
    want = sorted(expected.fetchall())
    assert sorted(map(tuple, frame.select(names).collect())) == want and want
