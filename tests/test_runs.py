"""Weekly run and streaming ingest."""

from datetime import date

import pytest
from helpers import programme, write_drop

from slotmill import fixed
from slotmill.errors import BadCells
from slotmill.plans.audit import read_audit
from slotmill.plans.report import ReportSpec
from slotmill.plans.weekly import weekly_run
from slotmill.session import shared_root, work_folder
from slotmill.sources.loaded import read_loaded
from slotmill.streaming.arrivals import start_ingest

DAY = date(2024, 2, 26)


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("root", "target", "out", "audit")}


def outcomes(spark, places):
    rows = read_audit(spark, places["audit"]).orderBy("run_ts").collect()
    return [(r.outcome, r.file_name, r.loaded_rows, r.replaced_rows, r.nonblank_lines) for r in rows]


def test_success_rerun_and_missing_file(spark, places):
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1), programme(2)])
    assert weekly_run(spark, **places, import_date=DAY) == "success"
    assert weekly_run(spark, **places, import_date=DAY) == "success"
    report = spark.read.parquet(f"{places['out']}/F240223B")
    assert report.count() == 2 and dict(report.dtypes)["START_TIME"] == "bigint"
    assert {(r.TX_DATE, r.TX_DATE_DATE) for r in report.collect()} == {("23/02/2024", date(2024, 2, 23))}
    assert spark.read.parquet(f"{places['out']}/{fixed.TITLE_DATASET}").count() == 15

    write_drop(places["root"], "2024-03-04", "G240301A.TXT", [programme(1)])
    assert weekly_run(spark, **places, import_date=DAY) == "warning"
    assert outcomes(spark, places) == [
        ("success", "F240223B", 2, 0, 2), ("success", "F240223B", 2, 2, 2), ("warning", None, None, None, None),
    ]


def test_other_failures_are_recorded_and_raised(spark, places):
    with pytest.raises(FileNotFoundError):
        weekly_run(spark, **places, import_date=DAY)
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1, START_TIME="six")])
    with pytest.raises(Exception, match="six"):
        weekly_run(spark, **places, import_date=DAY)
    assert [o[:3] for o in outcomes(spark, places)] == [("error", None, None), ("error", "F240223B", 1)]


def test_all_faults_of_a_run_are_written_before_it_fails(spark, places):
    lines = [programme(1, START_TIME="six"), programme(2), programme(3, LOADING_FACTOR="", SLOT_DURATION="1.5")]
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", lines)
    with pytest.raises(BadCells, match="3 bad cells in F240223B"):
        weekly_run(spark, **places, import_date=DAY, list_faults=True)
    faults = {(r.column, r.value) for r in spark.read.parquet(f"{places['out']}/F240223B faults").collect()}
    assert faults == {("START_TIME", "six"), ("LOADING_FACTOR", None), ("SLOT_DURATION", "1.5")}
    report = spark.read.parquet(f"{places['out']}/F240223B")
    assert report.count() == 3 and "TX_DATE_DATE" in report.columns
    assert spark.read.parquet(f"{places['out']}/{fixed.TITLE_DATASET}").count() == 15
    assert [o[0] for o in outcomes(spark, places)] == ["error"]


def test_own_report_specs(spark, places):
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1), programme(2, GENRE="News")])
    sql = "SELECT GENRE, MAIN_TITLE FROM prelog WHERE file_name = :file_name AND import_date = :import_date"
    weekly_run(spark, **places, import_date=DAY, specs=[ReportSpec("genres", sql)])
    assert {r.GENRE for r in spark.read.parquet(f"{places['out']}/genres").collect()} == {"NULL", "News"}


def test_command_line(spark, places, tmp_path):
    import run_weekly

    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1), programme(2)])
    sql = tmp_path / "main.sql"
    sql.write_text(
        "SELECT TX_DATE AS `Broadcast Date`, TX_DATE AS `Start Date`, TX_DATE AS `End Date`, "
        "PROGRAMME_ID AS `Program ID`, REFERENCE_ID AS `Notes`, START_TIME AS `Content ID` FROM prelog "
        "WHERE file_name = :file_name AND import_date = :import_date"
    )
    argv = [f"--{name}={place}" for name, place in places.items()]
    assert run_weekly.main(argv + ["--import-date=2024-02-26", f"--main-sql={sql}", "--strict"]) == "success"
    main = spark.read.parquet(f"{places['out']}/{fixed.MAIN_DATASET}")
    assert {(r["Broadcast Date"], r["Program ID"], r["Content ID"], r.Notes) for r in main.collect()} == {
        ("23/02/2024", 1, 600, "NULL"), ("23/02/2024", 2, 600, "NULL"),
    }
    assert spark.read.parquet(f"{places['out']}/F240223B").count() == 2
    assert run_weekly.arguments(argv).file_prefix is None


def test_the_command_lists_one_import_day(spark, places, monkeypatch):
    import run_weekly
    from slotmill.plans import weekly

    days, real = [], weekly.read_loaded
    monkeypatch.setattr(weekly, "read_loaded", lambda s, target, day=None: days.append(day) or real(s, target, day))
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1)])
    argv = [f"--{name}={place}" for name, place in places.items()] + ["--import-date=2024-02-26"]
    assert run_weekly.main(argv) == "success" and days == [DAY]


def run_stream(spark, places, checkpoint, **options):
    start_ingest(spark, places["root"], places["target"], checkpoint, DAY, **options).awaitTermination()
    rows = read_loaded(spark, places["target"]).groupBy("file_name").count().collect()
    return {r.file_name: r["count"] for r in rows}


def test_stream_loads_each_file_once(spark, places, tmp_path):
    checkpoint = str(tmp_path / "progress")
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1)])
    write_drop(places["root"], "2024-02-26", "G240223A.TXT", [programme(1)])
    write_drop(places["root"], "archive", "F240222A.TXT", [programme(1)])
    assert run_stream(spark, places, checkpoint) == {"F240223A": 1}
    assert run_stream(spark, places, checkpoint) == {"F240223A": 1}
    write_drop(places["root"], "2024-02-27", "F240223B.TXT", [programme(i) for i in range(3)])
    write_drop(places["root"], "2024-02-27", "F240224A.TXT", [programme(i) for i in range(2)])
    assert run_stream(spark, places, checkpoint) == {"F240223A": 1, "F240223B": 3, "F240224A": 2}


def test_stream_in_small_batches(spark, places, tmp_path):
    for day in range(1, 6):
        write_drop(places["root"], "2024-02-26", f"F24020{day}A.TXT", [programme(i) for i in range(day)])
    loaded = run_stream(spark, places, str(tmp_path / "progress"), files_per_batch=2)
    assert loaded == {f"F24020{day}A": day for day in range(1, 6)}


def test_copies_in_one_batch_count_once(spark, places, tmp_path):
    write_drop(places["root"], "2024-02-27", "F240223A.TXT", [programme(i) for i in range(3)])
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1)])
    assert run_stream(spark, places, str(tmp_path / "progress")) == {"F240223A": 3}


@pytest.mark.parametrize("files_per_batch", [1000, 1])
def test_batches_do_not_change_the_table(spark, places, tmp_path, files_per_batch):
    import os

    newer = write_drop(places["root"], "2024-02-27", "F240223A.TXT", [programme(i) for i in range(3)])
    older = write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1)])
    blank = write_drop(places["root"], "2024-02-26", "F240222A.TXT", [" "])
    write_drop(places["root"], "2024-02-26", "F240223AA.TXT", [programme(1)])
    for age, path in enumerate((older, blank, newer)):
        os.utime(path, (1_700_000_000 - 100 * age,) * 2)
    options = {"files_per_batch": files_per_batch, "audit": places["audit"]}
    assert run_stream(spark, places, str(tmp_path / "one"), **options) == {"F240223A": 3, "F240223AA": 1}
    records = read_audit(spark, places["audit"])
    assert records.count() == (4 if files_per_batch == 1 else 1)
    assert run_stream(spark, places, str(tmp_path / "one"), **options) == {"F240223A": 3, "F240223AA": 1}
    assert read_audit(spark, places["audit"]).count() == records.count()
    write_drop(places["root"], "2024-02-28", "F240223A.TXT", [])
    for _ in range(2):
        assert run_stream(spark, places, str(tmp_path / "one"), **options) == {"F240223AA": 1}


@pytest.mark.parametrize("files_per_batch", [1000, 1])
def test_corrected_emptied_and_refilled_drops(spark, places, tmp_path, files_per_batch):
    checkpoint, options = str(tmp_path / "progress"), {"files_per_batch": files_per_batch}
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(i) for i in range(3)])
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(i) for i in range(2)])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223A": 3, "F240223B": 2}
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(i) for i in range(7)])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223A": 7, "F240223B": 2}
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223B": 2}
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(i) for i in range(5)])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223A": 5, "F240223B": 2}
    # an older copy that is corrected later changes nothing
    write_drop(places["root"], "2024-02-25", "F240223A.TXT", [programme(1)])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223A": 5, "F240223B": 2}
    write_drop(places["root"], "2024-02-25", "F240223A.TXT", [programme(1), programme(2)])
    assert run_stream(spark, places, checkpoint, **options) == {"F240223A": 5, "F240223B": 2}


def test_a_drop_that_is_gone_before_its_batch(spark, places, tmp_path, monkeypatch):
    from pathlib import Path

    from slotmill.streaming import arrivals

    real = arrivals.note_arrivals
    path = write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1)])
    write_drop(places["root"], "2024-02-26", "F240223B.TXT", [programme(1)])

    def noted(*args):
        notes = real(*args)
        Path(path).unlink(missing_ok=True)
        return notes

    monkeypatch.setattr(arrivals, "note_arrivals", noted)
    assert run_stream(spark, places, str(tmp_path / "progress")) == {"F240223B": 1}


def test_nothing_is_noted_twice(spark, places, tmp_path, monkeypatch):
    from slotmill.streaming import arrivals

    monkeypatch.setattr(arrivals, "LISTED_AT_ONCE", 2)
    checkpoint = str(tmp_path / "progress")
    for n in range(5):
        write_drop(places["root"], "2024-02-26", f"F24022{n}A.TXT", [programme(1)])
    written = []
    for _ in range(2):
        notes = arrivals.note_arrivals(spark, places["root"], checkpoint, files_per_batch=2)
        written.append(sorted((tmp_path / "progress" / "arrivals").glob("part-*")))
    assert written[0] == written[1] and all(spark.read.parquet(str(note)).count() <= 2 for note in written[0])
    found = spark.read.parquet(notes)
    assert found.count() == 5 and found.select("path").distinct().count() == 5


def test_an_interrupted_batch_is_loaded_by_the_next_start(spark, places, tmp_path, monkeypatch):
    from slotmill.streaming import arrivals

    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1)])
    checkpoint = str(tmp_path / "progress")
    with monkeypatch.context() as patched:
        patched.setattr(arrivals, "load_files", lambda *a, **b: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run_stream(spark, places, checkpoint)
    assert run_stream(spark, places, checkpoint) == {"F240223A": 1}


def test_an_any_year_run_takes_the_newest_folder(spark, places):
    write_drop(places["root"], "2024-12-30", "F241229A.TXT", [programme(1)])
    write_drop(places["root"], "2026-11-30", "F261129A.TXT", [programme(1), programme(2)])
    assert weekly_run(spark, **places, import_date=date(2026, 12, 1)) == "success"
    row = read_audit(spark, places["audit"]).first()
    assert (row.file_name, row.loaded_rows, row.matched, row.short_rows) == ("F261129A", 2, True, 0)


def test_replayed_stream_leaves_the_same_table(spark, places, tmp_path):
    write_drop(places["root"], "2024-02-26", "F240223A.TXT", [programme(1), programme(2)])
    for attempt in ("one", "two"):
        assert run_stream(spark, places, str(tmp_path / attempt)) == {"F240223A": 2}


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "yarn"
        applicationId = "x"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert shared_root(Session()) == "hdfs:///shared"


def test_work_folders_lie_below_the_shared_root(spark):
    folder = work_folder(spark, "x")
    assert folder.startswith(shared_root(spark)) and folder != work_folder(spark, "x")
