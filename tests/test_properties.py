from datetime import date, datetime

from helpers import write_drop
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotmill.functions.numbers import lenient_text
from slotmill.operators import gate
from slotmill.operators.reconcile import reconcile
from slotmill.operators.replace import replace_by_key
from slotmill.sources.prelog import read_lines, read_prelog

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
# anything but line ends and the few blanks that the row reader keeps as rows
text = st.text(st.characters(codec="utf-8", exclude_categories=("Cc", "Cs", "Zs", "Zl", "Zp")), max_size=12)
keys = st.tuples(st.sampled_from([date(2024, 2, 26), date(2024, 2, 27)]), st.sampled_from("abc"), st.integers(0, 9))


@few
@given(st.lists(st.lists(text, min_size=1, max_size=30).map("\t".join), max_size=20))
def test_counts_agree_for_any_text(spark, tmp_path, lines):
    path = write_drop(tmp_path, "d", "F240223A.TXT", lines)
    rows = reconcile(read_prelog(spark, path), read_lines(spark, path)).collect()
    assert all(row.matched for row in rows)
    assert sum(row.loaded_rows for row in rows) == sum(1 for line in lines if line.strip())


@few
@given(st.lists(keys, max_size=20), st.lists(keys, min_size=1, max_size=5))
def test_replacing_twice_is_replacing_once(spark, old, new):
    schema = "import_date date, file_name string, value int"
    target, load = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    once = replace_by_key(target, load)
    touched = {row[:2] for row in new}
    expected = sorted([row for row in old if row[:2] not in touched] + new)
    assert sorted(tuple(r) for r in once.collect()) == expected
    assert sorted(tuple(r) for r in replace_by_key(once, load).collect()) == expected


@few
@given(st.lists(text.filter(lambda t: not any(c.isnumeric() for c in t)), min_size=1, max_size=20))
def test_lenient_numbers_keep_other_text(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert frame.filter(~lenient_text(F.col("t")).eqNullSafe(F.col("t"))).count() == 0


@few
@given(st.lists(st.sampled_from([1, 2, 3]), max_size=4), st.sets(st.sampled_from([-1, 1, 2, 3]), min_size=1))
def test_gate_is_monotone(spark, statuses, allowed):
    schema = "log_id string, log_task_id int, status_flag int, log_msg string, event_ts timestamp, seq bigint"
    rows = [(str(i), i, status, "", datetime(2024, 2, 26, 9), i) for i, status in enumerate(statuses)]
    log = spark.createDataFrame(rows, schema)

    def passed(codes):
        tasks = {f"t{i}": {"log_task_id": i, "allowed_status": sorted(codes)} for i in range(4)}
        return gate.tasks_passed(spark, log, date(2024, 2, 26), tasks)

    latest = set(statuses) | ({-1} if len(statuses) < 4 else set())
    assert passed(allowed) == (latest <= allowed)
    assert not passed(allowed) or passed(allowed | {-1, 1, 2, 3})
