"""Physical plans that scale depends on: what is pushed down, shuffled and broadcast."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from slotmill.operators import gate, runlog
from slotmill.operators.calendar import holiday_flags
from slotmill.operators.replace import existing_rows, replace_by_key
from slotmill.plans import showcase
from slotmill.plans.ingest import load_files
from slotmill.plans.weekly import weekly_run
from slotmill.sources import storage

SF_DIR = "/root/testdata/sf0.001"
DAY = date(2024, 1, 5)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


@pytest.mark.parametrize("name", [
    "candidate_files", "stamped_load", "date_parse_tolerant", "report_dates", "retype_dates", "strict_int",
    "lenient_numeric", "report_param", "title_semi", "invalid_allowed", "missing_fields",
])
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(showcase.QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name, pushed, columns", [
    ("report_param", "EqualTo(l_returnflag,R)", "l_extendedprice"),
    ("report_param", "GreaterThanOrEqual(l_shipdate,1997-01-01", "l_shipdate"),
    ("title_semi", "In(p_name, [hot ring,red plate,small widget])", "p_name"),
    ("existing_rows", "EqualTo(event_type,click)", "ts"),
    ("latest_status", "GreaterThanOrEqual(ts,2024-01-15", "user_id"),
])
def test_filters_reach_the_scan(spark, name, pushed, columns):
    plan = plan_of(showcase.QUERIES[name](spark, SF_DIR))
    assert pushed in plan and columns in plan.split("ReadSchema:")[1]


def test_scans_read_only_used_columns(spark):
    plan = plan_of(showcase.QUERIES["null_sentinel"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("latest_file_version", "log_current_state", "latest_status", "latest_folder", "nonblank_lines"):
        plan = plan_of(showcase.QUERIES[name](spark, SF_DIR))
        assert "partial_" in plan and plan.index("Exchange") < plan.index("partial_"), name


def test_building_a_plan_starts_no_job(spark):
    events = showcase.keyed_events(spark, SF_DIR)
    log, tasks = showcase.event_log(spark, SF_DIR), showcase.customer_tasks(spark, SF_DIR)
    holidays = spark.createDataFrame([(DAY,)], "date date")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    for frame in (
        replace_by_key(events, events.filter("file_name = 'click'")),
        holiday_flags(events, "import_date", holidays, 1),
        gate.task_gate(log, tasks, DAY, as_of=True),
    ):
        plan_of(frame)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_the_log_is_aggregated_before_it_meets_the_tasks(spark, no_auto_broadcast):
    log, tasks = showcase.event_log(spark, SF_DIR), showcase.customer_tasks(spark, SF_DIR)
    plan = plan_of(gate.task_gate(log, tasks, DAY, as_of=True))
    assert plan.index("SortMergeJoin") < plan.index("max_by") and "log_msg" not in plan
    assert "Generate" not in plan


def test_the_gate_reads_only_used_columns(spark):
    plan = plan_of(showcase.QUERIES["latest_status_gate_rows"](spark, SF_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_counting_a_key_needs_one_row_per_task(spark):
    frame = existing_rows(showcase.keyed_events(spark, SF_DIR), file_name="click", import_date=DAY)
    assert "partial_count" in plan_of(frame)
    assert frame.filter(F.col("existing_rows") < 0).count() == 0


@pytest.mark.parametrize("name, loads", [("run_outcomes", 4), ("keyed_replace_emptied", 2), ("reconcile_per_file", 1)])
def test_made_up_drops_do_not_go_through_one_task(spark, tmp_path, monkeypatch, name, loads):
    """Tables of four files give drops of several part files each, none of which holds most of the lines."""
    sf_dir, key, spread = str(tmp_path / "tables"), F.col("id"), []
    kinds, statuses = (F.array(*map(F.lit, names)) for names in (("click", "view", "error"), ("F", "O", "P")))
    spark.range(0, 2000, 1, 4).select(
        key.alias("o_orderkey"), (key % 50).alias("o_custkey"), F.get(statuses, (key % 3).cast("int")).alias("o_orderstatus"), F.lit(DAY).alias("o_orderdate"),
        F.when(key % 10 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"), (key + 0.5).alias("o_totalprice"),
    ).write.parquet(f"{sf_dir}/orders.parquet")
    spark.range(0, 2000, 1, 4).select(
        key.alias("event_id"), (key % 50).alias("user_id"), F.get(kinds, (key % 3).cast("int")).alias("event_type"), F.lit(DAY).cast("timestamp").alias("ts"),
        F.sha2(key.cast("string"), 256).alias("props"), (key + 0.5).alias("value"),
    ).write.parquet(f"{sf_dir}/events.parquet")

    def lengths(path):
        return [e.length for e in storage.listing(spark, path) if e.name.startswith(("part-", "F", "click", "view", "error"))]

    def run(session, root, **options):
        folder = f"{root}/{options['import_date'].isoformat()}"
        spread.append([lengths(e.path) for e in storage.listing(spark, folder) if not e.name.startswith(".")])
        return weekly_run(session, root, **options)

    def load(session, paths, *rest, **options):
        spread.append([lengths(path) for path in paths])
        return load_files(session, paths, *rest, **options)

    monkeypatch.setattr(showcase, "weekly_run", run)
    monkeypatch.setattr(showcase, "load_files", load)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(setting)
    spark.conf.set(setting, "10k")
    try:
        rows = showcase.QUERIES[name](spark, sf_dir).collect()
    finally:
        spark.conf.set(setting, previous)
    assert len(spread) == loads and rows
    for parts in (p for drops in spread for p in drops if sum(p)):
        assert max(parts) < 0.75 * sum(parts), parts
