import decimal
from datetime import date, datetime

import pytest
from helpers import programme, schedule_row, write_drop
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.functions.dates import tolerant_date
from slotmill.functions.numbers import lenient_double, lenient_number, lenient_text, strict_int
from slotmill.operators.retype import retype_date_columns
from slotmill.operators.titles import exclusive_titles, rows_with_titles
from slotmill.plans.ingest import load_files
from slotmill.errors import BadCells
from slotmill.plans.report import (
    ReportSpec,
    checked_report,
    clean_report,
    export_checked,
    export_datasets,
    main_spec,
    register_loaded,
    run_report,
    secondary_spec,
)
from slotmill.sources.prelog import read_prelog

DAY = date(2024, 2, 26)


def test_main_report_columns(spark):
    data = spark.createDataFrame(
        [(date(2024, 2, 3), datetime(2024, 1, 2, 8), "2024-12-31", "0600", 7.0, None, "")],
        "`Broadcast Date` date, `Start Date` timestamp, `End Date` string, `Program ID` string, "
        "`Content ID` double, Genre string, Notes string",
    )
    data.createOrReplaceTempView("titles_of_day")
    report = run_report(spark, main_spec("SELECT * FROM titles_of_day"), {})
    assert tuple(report.first()) == ("03/02/2024", "02/01/2024", "31/12/2024", 600, 7, "NULL", "")
    assert dict(report.dtypes)["Program ID"] == "bigint"


def test_secondary_report_end_to_end(spark, tmp_path):
    target = str(tmp_path / "prelog")
    lines = [programme(1, PROGRAMME_ID="ASG23"), programme(2, START_TIME="2359", GENRE="News")]
    paths = [write_drop(tmp_path, "d", "F240223B.TXT", lines), write_drop(tmp_path, "d", "F240223A.TXT", [programme(3)])]
    load_files(spark, paths, target, DAY)
    register_loaded(spark, target)
    args = {"file_name": "F240223B", "import_date": DAY}
    report = run_report(spark, secondary_spec("F240223B"), args).orderBy("MAIN_TITLE")
    first, second = report.collect()
    assert (first.import_date, first.TX_DATE, first.START_TIME) == ("26/02/2024", "23/02/2024", 600)
    assert (first.PROGRAMME_ID, first.PROGRAMME_ID_NUMBER) == ("ASG23", None)
    assert (second.PROGRAMME_ID, second.PROGRAMME_ID_NUMBER, second.START_TIME) == ("2", 2, 2359)
    assert (first.GENRE, second.GENRE) == ("NULL", "News")


def test_report_prunes_to_the_loaded_partition(spark, tmp_path):
    target = str(tmp_path / "prelog")
    load_files(spark, [write_drop(tmp_path, "d", "F240223B.TXT", [programme(1)])], target, DAY)
    register_loaded(spark, target)
    report = run_report(spark, secondary_spec("x"), {"file_name": "F240223B", "import_date": DAY})
    plan = report._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:"):].split("PushedFilters")[0]
    assert "file_name" in filters and "import_date" in filters


@pytest.mark.parametrize("column, value", [("day", None), ("day", "NULL"), ("n", None), ("n", "1.5"), ("n", "NULL")])
def test_bad_typed_values_fail(spark, column, value):
    row = {"day": "2024-02-03", "n": "1", column: value}
    frame = spark.createDataFrame([(row["day"], row["n"])], "day string, n string")
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        clean_report(frame, ReportSpec("r", "", ("day",), ("n",))).collect()


def test_nulls_can_be_kept(spark):
    frame = spark.createDataFrame([(None, None, None, None)], "day string, n string, text string, plain int")
    kept = clean_report(frame, ReportSpec("r", "", ("day",), ("n",), on_null="keep"))
    assert tuple(kept.first()) == (None, None, "NULL", None)
    with pytest.raises(ValueError):
        ReportSpec("r", "", on_null="drop")


def test_unknown_report_column(spark):
    with pytest.raises(ValueError, match="no column"):
        clean_report(spark.range(1), ReportSpec("r", "", ("day",)))


def test_strictness_does_not_depend_on_ansi(spark):
    frame = spark.createDataFrame([("12x",)], "n string")
    previous = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="12x"):
            frame.select(strict_int(F.col("n"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)


def test_fractions_fail_and_whole_numbers_pass(spark):
    frame = spark.createDataFrame([(2.0, decimal.Decimal("3.00"))], "d double, e decimal(10,2)")
    types = {f.name: f.dataType for f in frame.schema}
    assert tuple(frame.select(strict_int(F.col("d"), types["d"]), strict_int(F.col("e"), types["e"])).first()) == (2, 3)
    with pytest.raises(Exception, match="2.5"):
        spark.createDataFrame([(2.5,)], "d double").select(strict_int(F.col("d"), types["d"])).collect()


def test_lenient_numbers(spark):
    cases = {"000123": ("123", 123), "ASG23": ("ASG23", None), "1.5": ("1.5", None), "": ("", None), "-04": ("-4", -4)}
    frame = spark.createDataFrame([(text,) for text in cases], "t string")
    rows = frame.select("t", lenient_text(F.col("t")), lenient_number(F.col("t"))).collect()
    assert {row[0]: (row[1], row[2]) for row in rows} == cases


def test_numbers_with_fraction_exponent_or_many_digits(spark):
    cases = {"1.5": 1.5, "1.50": 1.5, "1e3": 1000.0, "007": 7.0, "9" * 30: 1e30, ".5": 0.5, "NaN": None, "1d": None, "": None, "A1": None}
    frame = spark.createDataFrame([(text,) for text in cases], "t string")
    assert {r.t: r.n for r in frame.select("t", lenient_double(F.col("t")).alias("n")).collect()} == cases


def test_display_text_back_to_dates(spark):
    frame = spark.createDataFrame([("03/02/2024",), ("NULL",), ("31/02/2024",)], "t string")
    assert [r[0] for r in frame.select(tolerant_date(F.col("t"), fixed.DISPLAY_DATE_PATTERN)).collect()] == [date(2024, 2, 3), None, None]


def test_named_columns_that_exist_get_dates(spark):
    frame = spark.createDataFrame([("03/02/2024", datetime(2024, 2, 4, 5), "x")], "`Start Date` string, at timestamp, t string")
    typed = retype_date_columns(frame, ["Start Date", "at", "absent"])
    assert typed.columns == ["Start Date", "at", "t", "Start Date_DATE", "at_DATE"]
    assert tuple(typed.first())[3:] == (date(2024, 2, 3), date(2024, 2, 4))


def test_title_list(spark):
    titles = [r[0] for r in exclusive_titles(spark).collect()]
    assert titles == fixed.EXCLUSIVE_TITLES and len(titles) == 15
    rows = spark.createDataFrame([("Space Farmers", 1), ("space farmers", 2), (None, 3)], "t string, n int")
    assert [r.n for r in rows_with_titles(rows, "t").collect()] == [1]


def test_export_one_folder_per_dataset(spark, tmp_path):
    out = str(tmp_path / "out dir")
    datasets = {fixed.MAIN_DATASET: spark.range(3), fixed.TITLE_DATASET: exclusive_titles(spark)}
    for _ in range(2):
        folders = export_datasets(datasets, out)
    assert spark.read.parquet(folders[fixed.MAIN_DATASET]).count() == 3
    assert [r[0] for r in spark.read.parquet(folders[fixed.TITLE_DATASET]).collect()] == fixed.EXCLUSIVE_TITLES
    csv = export_datasets({"titles": exclusive_titles(spark)}, out, fmt="csv", header=True)["titles"]
    assert spark.read.option("header", True).csv(csv).columns == [fixed.TITLE_COLUMN]


def test_empty_strings_survive_the_reader_as_null(spark, tmp_path):
    path = write_drop(tmp_path, "d", "F240223A.TXT", [schedule_row(CHANNEL_ID="1")])
    assert read_prelog(spark, path).first().GENRE is None


FAULTY = ReportSpec("faulty", "", ("day",), ("n", "d"), ("mixed",), key_columns=("day", "my key"))


def faulty_rows(spark):
    rows = [
        ("2024-02-03", "7", 2.0, "0600", 1, "k"), ("NULL", "1.5", 2.5, "x", 2, None), (None, None, None, None, 3, "c"), ("2024-13-01", " 8 ", 1.0, "", 4, "d"),
    ]
    return spark.createDataFrame(rows, "day string, n string, d double, mixed string, `my key` int, t string")


def test_all_bad_cells_are_listed_and_the_rest_is_clean(spark, tmp_path):
    checked = checked_report(faulty_rows(spark), FAULTY)
    with pytest.raises(BadCells, match="7 bad cells in faulty"):
        export_checked({FAULTY: checked}, str(tmp_path))
    faults = {(r["my key"], r.day, r.column, r.value, r.reason) for r in spark.read.parquet(f"{tmp_path}/faulty faults").collect()}
    assert faults == {
        (2, "NULL", "day", "NULL", "not a date"), (2, "NULL", "n", "1.5", "not a whole number"), (2, "NULL", "d", "2.5", "not a whole number"),
        (3, None, "day", None, "null"), (3, None, "n", None, "null"), (3, None, "d", None, "null"),
        (4, "2024-13-01", "day", "2024-13-01", "not a date"),
    }
    report = spark.read.parquet(f"{tmp_path}/faulty")
    assert report.columns == clean_report(faulty_rows(spark), FAULTY).columns
    rows = {r["my key"]: (r.day, r.n, r.d, r.mixed, r.t) for r in report.collect()}
    assert rows == {1: ("03/02/2024", 7, 2, "600", "k"), 2: (None, None, None, "x", "NULL"), 3: (None, None, None, "NULL", "c"), 4: (None, 8, 1, "", "d")}
    sound = faulty_rows(spark).filter("`my key` = 1")
    same = checked_report(sound, FAULTY).select(clean_report(sound, FAULTY).columns)
    assert same.collect() == clean_report(sound, FAULTY).collect()


def test_kept_nulls_are_no_faults(spark, tmp_path):
    spec = ReportSpec("kept", "", ("day",), ("n",), on_null="keep")
    rows = spark.createDataFrame([(None, None), ("2024-01-01", "1")], "day string, n string")
    folders = export_checked({spec: checked_report(rows, spec)}, str(tmp_path))
    assert spark.read.parquet(folders["kept faults"]).columns == ["column", "value", "reason"]
    assert spark.read.parquet(folders["kept faults"]).count() == 0 and spark.read.parquet(folders["kept"]).count() == 2
    with pytest.raises(ValueError):
        export_checked({}, str(tmp_path), on_fault="ignore")
    with pytest.raises(ValueError, match="no column missing"):
        checked_report(rows, ReportSpec("x", "", key_columns=("missing",)))


def test_a_report_without_typed_columns_has_no_faults(spark):
    spec = ReportSpec("plain", "")
    checked = checked_report(spark.createDataFrame([("a",)], "t string"), spec)
    assert checked.first()["_faults"] == []
