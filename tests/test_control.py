"""Run log, gate and calendar."""

import uuid
from datetime import date, datetime, timedelta

import pytest

from slotmill.errors import BadRequirement, UnknownLogId
from slotmill.operators import gate, runlog
from slotmill.operators.calendar import holiday_flags, is_holiday
from slotmill.sources.jdbc import ONE_TASK, Database, Split, narrowed, query_options, write_options
from slotmill.sources.sql import query_rows, query_table

DAY = date(2022, 4, 28)
NOON = datetime(2022, 4, 28, 12)


def log_frame(spark, rows):
    full = [(str(i), task, status, "", at, i) for i, (task, status, at) in enumerate(rows)]
    return spark.createDataFrame(full, "log_id string, log_task_id int, status_flag int, log_msg string, event_ts timestamp, seq bigint")


def test_log_rows_and_updates(spark, tmp_path):
    path = str(tmp_path / "task_log")
    status, log_id = runlog.append_log(spark, path, -99, 2, "it's started", NOON)
    assert status == 1 and log_id.startswith("20220428-") and uuid.UUID(log_id[9:])
    runlog.append_log(spark, path, 88, 1, "other", NOON)
    runlog.update_log(spark, path, log_id, -99, 1, "this is 't '' test 123", NOON + timedelta(hours=1))
    current = {r.log_id: r for r in runlog.current_log(runlog.read_log(spark, path)).collect()}
    assert len(current) == 2
    assert (current[log_id].status_flag, current[log_id].log_msg) == (1, "this is 't '' test 123")
    assert runlog.read_log(spark, path).count() == 3


def test_same_time_updates_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "task_log")
    _, log_id = runlog.append_log(spark, path, 1, 2, "a", NOON)
    for status in (3, 1):
        runlog.update_log(spark, path, log_id, 1, status, "b", NOON)
    assert runlog.current_log(runlog.read_log(spark, path)).first().status_flag == 1


def test_an_update_with_an_earlier_time_shows(spark, tmp_path):
    path = str(tmp_path / "task_log")
    _, log_id = runlog.append_log(spark, path, 1, 2, "a", NOON)
    runlog.update_log(spark, path, log_id, 1, 1, "b", NOON - timedelta(days=3))
    row = runlog.current_log(runlog.read_log(spark, path)).first()
    assert (row.status_flag, row.log_msg, row.event_ts) == (1, "b", NOON - timedelta(days=3))
    plan = runlog.versions_of(runlog.read_log(spark, path), log_id)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters:"):].split("PushedFilters")[0]


def test_merged_files_hold_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "task_log")
    for i in range(5):
        runlog.append_log(spark, path, i, 1, "a", NOON)
    before = sorted(runlog.read_log(spark, path).collect())
    runlog.merge_files(spark, path, DAY)
    runlog.merge_files(spark, path, DAY + timedelta(days=9))
    assert sorted(runlog.read_log(spark, path).collect()) == before
    assert len(list((tmp_path / "task_log" / "event_date=2022-04-28").glob("*.parquet"))) == 1
    assert not list((tmp_path / "task_log").glob("_merge*"))


def test_update_needs_a_known_id(spark, tmp_path):
    path = str(tmp_path / "task_log")
    runlog.append_log(spark, path, 1, 2, "a", NOON)
    with pytest.raises(ValueError):
        runlog.update_log(spark, path, None, 1, 1, "b")
    with pytest.raises(UnknownLogId):
        runlog.update_log(spark, path, "nobody", 1, 1, "b")


def test_latest_status_on_or_up_to_a_day(spark):
    log = log_frame(
        spark,
        [
            (88, 2, NOON), (88, 1, NOON + timedelta(hours=2)), (88, 3, NOON + timedelta(days=1)),
            (89, 1, NOON - timedelta(days=1)), (90, 1, datetime(2022, 4, 28)), (91, 1, datetime(2022, 4, 29)),
        ],
    )
    assert {tuple(r) for r in runlog.latest_status(log, DAY).collect()} == {(88, 1), (90, 1)}
    assert {tuple(r) for r in runlog.latest_status(log, DAY, as_of=True).collect()} == {(88, 1), (89, 1), (90, 1)}


def test_stored_log_prunes_days(spark, tmp_path):
    path = str(tmp_path / "task_log")
    for shift in range(-3, 4):
        runlog.append_log(spark, path, 88, 1 if shift else 3, "", NOON + timedelta(days=shift))
    frame = runlog.latest_status(runlog.read_log(spark, path), DAY)
    assert [tuple(r) for r in frame.collect()] == [(88, 3)]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters:"):].split("PushedFilters")[0]


def test_an_update_with_an_earlier_time_decides(spark, tmp_path):
    """Whichever way round: the version written last is the status, and the other is none."""
    for first, second, passed in ((2, 1, True), (1, 2, False)):
        path = str(tmp_path / f"task_log{first}")
        _, log_id = runlog.append_log(spark, path, 88, first, "", NOON)
        runlog.update_log(spark, path, log_id, 88, second, "", NOON - timedelta(hours=1))
        log = runlog.read_log(spark, path)
        assert [tuple(r) for r in runlog.latest_status(log, DAY).collect()] == [(88, second)]
        task = {"upload": {"log_task_id": 88, "allowed_status": [1]}}
        assert gate.tasks_passed(spark, log, DAY, task) is passed
        assert gate.task_gate(log, gate.prerequisite_frame(spark, task), DAY).first().passed is passed


def test_an_update_moves_a_row_to_its_day_and_task(spark, tmp_path):
    path = str(tmp_path / "task_log")
    _, moved = runlog.append_log(spark, path, 88, 1, "", NOON)
    _, other = runlog.append_log(spark, path, 89, 1, "", NOON)
    runlog.update_log(spark, path, moved, 88, 3, "", NOON + timedelta(days=40))
    runlog.update_log(spark, path, other, 90, 2, "", NOON)
    log = runlog.read_log(spark, path)
    assert {tuple(r) for r in runlog.latest_status(log, DAY).collect()} == {(90, 2)}
    assert runlog.latest_status(log, DAY, as_of=True, task_ids=[88, 89]).collect() == []
    later = DAY + timedelta(days=40)
    assert {tuple(r) for r in runlog.latest_status(log, later, as_of=True).collect()} == {(88, 3), (90, 2)}
    assert not gate.tasks_passed(spark, log, DAY, {"a": {"log_task_id": 88, "allowed_status": [1, 3]}})


def test_rows_without_an_id_are_rows_of_their_own(spark):
    rows = [(None, 1, 2, "", NOON, 1), (None, 2, 3, "", NOON, 2), ("a", 1, 1, "", NOON - timedelta(hours=1), 3)]
    log = spark.createDataFrame(rows, "log_id string, log_task_id int, status_flag int, log_msg string, event_ts timestamp, seq bigint")
    assert {tuple(r) for r in runlog.latest_status(log, DAY).collect()} == {(1, 2), (2, 3)}


CALENDAR_TASKS = [
    ("x", 88, [1]), ("x", 89, [1, 3]), ("y", 88, [-1, 1]), ("y", 90, [-1]), ("z", None, [1]), ("z", 88, None), ("v", 91, [2, None]),
]


@pytest.mark.parametrize("as_of", [False, True])
def test_gate_calendar_is_the_gate_of_each_day(spark, as_of):
    rows = [
        (88, 2, NOON), (88, 1, NOON + timedelta(hours=2)), (88, 3, NOON + timedelta(days=4)), (89, 3, NOON + timedelta(days=1)),
        (90, 1, NOON + timedelta(days=2)), (91, 2, NOON - timedelta(days=1)), (88, 1, None), (None, 1, NOON),
    ]
    log = log_frame(spark, rows)
    # the row of task 91 is replaced by one of another day
    log = log.union(spark.createDataFrame([("5", 91, 2, "", NOON + timedelta(days=3), 99)], log.schema))
    tasks = spark.createDataFrame(CALENDAR_TASKS, "set string, log_task_id int, allowed_status array<int>")
    days = [DAY + timedelta(days=n) for n in range(-3, 7)]
    references = spark.createDataFrame([(s, d) for s in ("x", "y", "z", "v", "w") for d in [*days, None, days[0]]], "set string, ref_date date")
    found = {(r.set, r.ref_date): (r.tasks, r.passing, r.passed) for r in gate.gate_calendar(log, tasks, references, ["set"], as_of).collect()}
    assert len(found) == 5 * len(days)
    for day in days:
        rows = gate.gate_rows(tasks, runlog.latest_status(log, day, as_of)).collect()
        for name in ("x", "y", "z", "v", "w"):
            own = [r.passed for r in rows if r.set == name]
            assert found[name, day] == (len(own), sum(own), all(own)), (name, day)


def test_gate_calendar_of_one_set(spark):
    log = log_frame(spark, [(88, 1, NOON)])
    tasks = gate.prerequisite_frame(spark, {"a": {"log_task_id": 88, "allowed_status": [1]}})
    references = spark.createDataFrame([(DAY + timedelta(days=n),) for n in range(-1, 2)], "ref_date date")
    found = {r.ref_date: r.passed for r in gate.gate_calendar(log, tasks, references, as_of=True).collect()}
    assert found == {DAY - timedelta(days=1): False, DAY: True, DAY + timedelta(days=1): True}
    assert gate.gate_calendar(log, tasks.limit(0), references).filter("NOT passed").count() == 0
    assert gate.gate_calendar(log, tasks, references.limit(0)).count() == 0


def test_gate(spark):
    log = log_frame(spark, [(88, 2, NOON), (88, 3, NOON + timedelta(hours=1)), (89, 1, NOON - timedelta(days=1))])
    upload = {"log_task_id": 88, "allowed_status": [1, 3]}
    check = {"log_task_id": 89, "allowed_status": [1]}
    absent = {"log_task_id": 90, "allowed_status": [-1, 1]}
    assert gate.tasks_passed(spark, log, "2022-04-28", {"upload": upload})
    assert not gate.tasks_passed(spark, log, DAY, {"upload": upload, "check": check})
    assert gate.tasks_passed(spark, log, DAY, {"upload": upload, "check": check}, as_of=True)
    assert gate.tasks_passed(spark, log, DAY, {"absent": absent, "again": upload})
    assert gate.tasks_passed(spark, log, DAY, {})


@pytest.mark.parametrize("task, allowed, passed", [
    (88, [3], True), (88, None, False), (88, [1, None], False), (88, [], False), (None, [-1, 3], False), (88, [3, None], True),
])
def test_gate_is_shut_where_a_field_is_missing(spark, task, allowed, passed):
    log = log_frame(spark, [(88, 3, NOON), (89, 1, NOON)])
    tasks = gate.prerequisite_frame(spark, {"a": {"log_task_id": task, "allowed_status": allowed}})
    assert gate.task_gate(log, tasks, DAY).first().passed is passed
    rows = gate.gate_rows(tasks, runlog.latest_status(log, DAY))
    assert rows.first().passed is passed and gate.gate_total(rows).first().passed is passed


def test_requirements(spark):
    with pytest.raises(BadRequirement, match="upload"):
        gate.tasks_passed(spark, log_frame(spark, [(1, 1, NOON)]), DAY, {"upload": {"log_task_id": 88}})
    with pytest.raises(BadRequirement, match=r"upload allows \[7\]"):
        gate.check_prerequisites(gate.prerequisite_frame(spark, {"upload": {"log_task_id": 88, "allowed_status": [1, 7]}}))
    frame = gate.prerequisite_frame(spark, {"a": {"allowed_status": [1]}, "b": {"log_task_id": 1, "allowed_status": []}})
    assert [tuple(r) for r in gate.missing_fields(frame).collect()] == [("a", True, False)]


@pytest.mark.parametrize("day, weekend, expected", [
    (date(2022, 4, 28), 1, False), (date(2022, 4, 30), 1, True), (date(2022, 4, 30), 0, False),
    (date(2022, 5, 1), 1, True), (date(2022, 5, 1), 0, True), (date(2022, 5, 2), 0, True),
])
def test_holidays(spark, day, weekend, expected):
    holidays = spark.createDataFrame([(date(2022, 5, 1),), (date(2022, 5, 2),), (date(2022, 5, 2),), (None,)], "date date")
    assert is_holiday(spark, day, weekend, holidays) is expected


def test_holiday_arguments_and_row_count(spark):
    holidays = spark.createDataFrame([(date(2022, 5, 2),)] * 3, "date date")
    with pytest.raises(ValueError):
        is_holiday(spark, DAY, 2, holidays)
    assert is_holiday(spark, "2022-05-02", 0, holidays)
    days = spark.createDataFrame([(date(2022, 5, 2), 1), (date(2022, 5, 3), 2)], "day date, n int")
    assert sorted(tuple(r) for r in holiday_flags(days, "day", holidays, 0).collect()) == [
        (date(2022, 5, 2), 1, True), (date(2022, 5, 3), 2, False),
    ]


def test_queries_bind_values(spark):
    names = spark.createDataFrame([("it's", 1), ("x' OR '1'='1", 2)], "name string, n int")
    sql = "SELECT n FROM names WHERE name = :name"
    assert [r.n for r in query_rows(spark, sql, {"name": "it's"}, {"names": names})] == [1]
    assert query_table(spark, sql, {"name": "' OR ''='"}, {"names": names}).count() == 0


def test_views_of_the_session_are_left_alone(spark):
    spark.range(3).createOrReplaceTempView("prelog")
    own = spark.range(5)
    before = {t.name for t in spark.catalog.listTables()}
    for sql in ("SELECT * FROM prelog -- all", "WITH x AS (SELECT * FROM prelog) SELECT * FROM x ORDER BY id;"):
        assert query_table(spark, sql, tables={"prelog": own}).count() == 5
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sum(1 for _ in query_rows(spark, "SELECT * FROM prelog")) == 3
    spark.catalog.dropTempView("prelog")


def test_jdbc_options():
    database = Database("jdbc:x://host", "x.Driver", "me", "secret", {"encrypt": "true"})
    assert "secret" not in repr(database)
    plain = query_options(database, "SELECT 1 AS n", ONE_TASK)
    assert plain["query"] == "SELECT 1 AS n" and "dbtable" not in plain
    split = query_options(database, "SELECT * FROM t", Split("n", 0, 100, 4))
    assert split["dbtable"] == "(SELECT * FROM t) q" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"], split["upperBound"]) == ("n", "4", "100")
    write = write_options(database, "prelog", connections=3)
    assert (write["dbtable"], write["numPartitions"], write["user"], write["encrypt"]) == ("prelog", "3", "me", "true")
    assert "user" not in Database("jdbc:x://host", "x.Driver").options()


def test_jdbc_writes_keep_the_tasks_before_them(spark):
    plan = narrowed(spark.range(0, 100, 1, 20), 3)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(3)" in plan
