"""Reports stored by name."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException

from slotmill.plans import stored
from slotmill.plans.report import ReportSpec


@pytest.fixture
def view(spark):
    rows = [(1, "a", date(2024, 1, 1), "7"), (2, "b", date(2024, 2, 1), "x"), (3, "a", date(2024, 3, 1), None)]
    spark.createDataFrame(rows, "n int, flag string, day date, amount string").createOrReplaceTempView("stored_rows")
    yield "stored_rows"
    spark.catalog.dropTempView("stored_rows")
    stored.drop_report(spark, "by flag")


PARAMETERS = (stored.Parameter("flag", "STRING"), stored.Parameter("since", "DATE", "DATE'2024-01-01'"))
SQL = "SELECT n, day, amount FROM stored_rows WHERE stored_rows.flag = `by flag`.flag AND day >= since;"


def test_called_by_name_with_typed_arguments(spark, view):
    stored.store_report(spark, "by flag", SQL, PARAMETERS)
    assert sorted(r.n for r in stored.call_report(spark, "by flag", {"flag": "a"}).collect()) == [1, 3]
    assert [r.n for r in stored.call_report(spark, "by flag", {"flag": "a", "since": "2024-02-01"}).collect()] == [3]
    assert stored.call_report(spark, "by flag", {"flag": "x' OR '1'='1"}).count() == 0
    assert [r.n for r in spark.sql("SELECT n FROM `by flag`('b') WHERE n > 1").collect()] == [2]
    with pytest.raises(AnalysisException):
        stored.call_report(spark, "by flag").count()
    with pytest.raises(AnalysisException):
        stored.call_report(spark, "by flag", {"flag": "a", "other": 1}).count()


def test_stored_again_and_dropped(spark, view):
    stored.store_report(spark, "by flag", SQL, PARAMETERS)
    before = stored.call_report(spark, "by flag", {"flag": "b"})
    stored.store_report(spark, "by flag", "SELECT 9 AS n")
    assert [r.n for r in stored.call_report(spark, "by flag").collect()] == [9]
    stored.drop_report(spark, "by flag")
    with pytest.raises(AnalysisException):
        stored.call_report(spark, "by flag")
    assert [r.n for r in before.collect()] == [2], "a frame keeps the report that it was made of"


def test_cleaned_like_other_reports(spark, view):
    stored.store_report(spark, "by flag", SQL, PARAMETERS)
    spec = ReportSpec("by flag", "", ("day",), ("amount",), key_columns=("n",))
    assert [tuple(r) for r in stored.run_stored(spark, "by flag", spec, {"flag": "a", "since": "2023-01-01"}).filter("n = 1").collect()] == [(1, "01/01/2024", 7)]
    checked = stored.run_stored(spark, "by flag", spec, {"flag": "b"}, strict=False).first()
    assert checked.amount is None and [f.reason for f in checked["_faults"]] == ["not a whole number"]


def test_filters_reach_the_scan(spark, tmp_path):
    place = str(tmp_path / "rows")
    spark.range(100).selectExpr("id", "cast(id % 3 as string) as flag", "id * 2 as other").write.parquet(place)
    spark.read.parquet(place).createOrReplaceTempView("stored_rows")
    stored.store_report(spark, "by flag", "SELECT id, other FROM stored_rows r WHERE r.flag = `by flag`.flag", PARAMETERS[:1])
    plan = stored.call_report(spark, "by flag", {"flag": "1"}).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(flag,1)" in plan and "other" not in plan.split("ReadSchema:")[1]
    stored.drop_report(spark, "by flag")
