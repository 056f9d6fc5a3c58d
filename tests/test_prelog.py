from datetime import date

import pytest
from helpers import programme, schedule_row, write_drop
from pyspark.sql import functions as F

from slotmill import fixed
from slotmill.functions.names import id_text
from slotmill.operators.reconcile import reconcile
from slotmill.operators.stamp import stamp, type_tx_date
from slotmill.plans.ingest import load_files, typed_rows
from slotmill.sources import prelog
from slotmill.sources.loaded import read_loaded

DAY = date(2024, 2, 26)

LINES = [
    programme(1),
    schedule_row(CHANNEL_ID="2", MAIN_TITLE='"quoted"'),
    schedule_row(CHANNEL_ID="3", MAIN_TITLE='"open', EPISODE_TITLE="part 1"),
    "4\tbelt",
    schedule_row(CHANNEL_ID="5", ALTERNATE_LANGUAGE="Malay") + "\textra",
    "",
    " \t  ",
    schedule_row(CHANNEL_ID="6", TX_DATE="20240230"),
    schedule_row(CHANNEL_ID="7", MAIN_TITLE="Pesta Kuih – 糕点\\n"),
]


@pytest.fixture
def drop(tmp_path):
    return write_drop(tmp_path, "2024-02-26", "F240223B.TXT", LINES)


def by_channel(frame):
    return {row.CHANNEL_ID: row for row in frame.collect()}


def test_fixed_schema_has_25_text_columns():
    assert len(prelog.RAW_SCHEMA) == 25
    assert {f.dataType.simpleString() for f in prelog.RAW_SCHEMA} == {"string"}
    assert prelog.PRELOG_SCHEMA.names[:5] == ["file_name", "import_date", "CHANNEL_ID", "CHANNEL_BELT", "TX_DATE"]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rows_of_odd_shape(spark, tmp_path, newline):
    path = write_drop(tmp_path, "2024-02-26", "F240223B.TXT", LINES, newline)
    rows = by_channel(prelog.read_prelog(spark, path))
    assert set(rows) == {"5", "2", "3", "4", "6", "7"}  # the first and the fifth line share channel 5
    assert prelog.read_prelog(spark, path).count() == 7
    assert (rows["4"].CHANNEL_BELT, rows["4"].TX_DATE) == ("belt", None)
    assert rows["7"].MAIN_TITLE == "Pesta Kuih – 糕点\\n"
    assert rows["7"].EPISODE_TITLE is None
    assert {row.source_file for row in rows.values()} == {"F240223B.TXT"}


def test_extra_fields_are_dropped(spark, drop):
    rows = prelog.read_prelog(spark, drop).filter("ALTERNATE_LANGUAGE IS NOT NULL").collect()
    assert [row.ALTERNATE_LANGUAGE for row in rows] == ["Malay"]


def test_quote_sign_is_text_by_default(spark, drop):
    rows = by_channel(prelog.read_prelog(spark, drop))
    assert rows["2"].MAIN_TITLE == '"quoted"'
    assert (rows["3"].MAIN_TITLE, rows["3"].EPISODE_TITLE) == ('"open', "part 1")


def test_quoting_can_be_turned_on(spark, drop):
    rows = by_channel(prelog.read_prelog(spark, drop, quote='"'))
    assert rows["2"].MAIN_TITLE == "quoted"
    assert rows["3"].MAIN_TITLE.startswith("open\tpart 1") and rows["3"].EPISODE_TITLE is None


def test_stamps_come_first_and_dates_are_typed(spark, drop):
    rows = typed_rows(spark, drop, date(2024, 2, 26))
    assert rows.schema.names == prelog.PRELOG_SCHEMA.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in prelog.PRELOG_SCHEMA]
    first = by_channel(rows.filter("MAIN_TITLE = 'Programme 1'"))["5"]
    assert (first.file_name, first.import_date, first.TX_DATE) == ("F240223B", date(2024, 2, 26), date(2024, 2, 23))
    assert by_channel(rows)["6"].TX_DATE is None


def test_tx_date_texts(spark):
    texts = spark.createDataFrame([("20240223",), ("20240230",), ("",), (None,), ("202402231",), ("x",)], "TX_DATE string")
    assert [r.TX_DATE for r in type_tx_date(texts).collect()] == [date(2024, 2, 23)] + [None] * 5
    with pytest.raises(Exception, match="20240230"):
        type_tx_date(texts.filter("TX_DATE LIKE '2024%0'"), strict=True).collect()


def test_source_names_with_blanks_and_signs(spark, tmp_path):
    path = write_drop(tmp_path, "2024 02", "F240223A+ é%41.TXT", [programme(1)])
    assert prelog.read_prelog(spark, path).first().source_file == "F240223A+ é%41.TXT"


def test_id_is_the_name_without_extension_or_a_part_of_it(spark):
    names = {"F240223AA.TXT": "F240223AA", "F240223A.TXT": "F240223A", "a.b.c": "a.b", ".TXT": ".TXT", "plain": "plain"}
    named = spark.createDataFrame([(n, 1) for n in names], "source_file string, x int")
    assert [r.file_name for r in stamp(named, date(2024, 2, 26)).collect()] == list(names.values())
    assert [id_text(n) for n in names] == list(names.values())
    assert stamp(named, date(2024, 2, 26), id_length=8).first().file_name == id_text("F240223AA.TXT", 8) == "F240223A"


def test_nonblank_lines_follow_python_strip(spark, tmp_path):
    blanks = ["", " ", "\t", "\u00a0", "\u2003 \u3000", "\x1c\x1f", "\u0085", "\x0b\x0c"]
    lines = blanks + ["a", "\u00a0b", "\u200b", "\ufeffc"]
    path = write_drop(tmp_path, "2024-02-26", "F240223B.TXT", lines)
    expected = sum(1 for line in lines if line.strip())
    assert prelog.line_profile(prelog.read_lines(spark, path)).first().nonblank_lines == expected == 4


def test_line_profile_counts(spark, drop):
    profile = prelog.line_profile(prelog.read_lines(spark, drop), by=["source_file"]).first()
    assert profile.asDict() == {
        "source_file": "F240223B.TXT", "lines": 9, "nonblank_lines": 7, "short_rows": 1, "long_rows": 1,
    }


def test_reconcile_per_file(spark, tmp_path):
    good = write_drop(tmp_path, "d", "F240223A.TXT", [programme(1), "", programme(2)])
    odd = write_drop(tmp_path, "d", "F240223B.TXT", [programme(1), "\u00a0"])
    empty = write_drop(tmp_path, "d", "F240223C.TXT", [" "])
    paths = [good, odd, empty]
    rows = reconcile(prelog.read_prelog(spark, paths), prelog.read_lines(spark, paths)).collect()
    assert {tuple(r) for r in rows} == {
        ("F240223A.TXT", 2, 2, True),
        ("F240223B.TXT", 2, 1, False),
        ("F240223C.TXT", 0, 0, True),
    }


def test_counting_reads_no_columns(spark, drop):
    frame = prelog.read_prelog(spark, drop).agg(F.count("*"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert len(fixed.PRELOG_COLUMNS) == len(set(fixed.PRELOG_COLUMNS))


def test_lines_that_quoting_damages(spark, tmp_path):
    full = lambda title, **more: programme(1, MAIN_TITLE=title, **more)
    damaged = [full('"open'), '"short\tx', programme(2) + '\t"long']
    sound = [full('"closed"'), full('"a "b'), full('in "the middle'), full('end"'), full('"a ""b"" c"'), full(""), "short", '"short"\tx', programme(3) + "\tlong", full('"two"', GENRE='"x"')]
    path = write_drop(tmp_path, "d", "F240223A.TXT", damaged + sound + [" ", ""])
    found = prelog.damaged_lines(prelog.read_lines(spark, path))
    assert {r.value for r in found.collect()} == set(damaged)
    assert {r.fields for r in found.filter("value LIKE '%open%'").collect()} == {25}


def test_damaged_lines_are_set_aside(spark, tmp_path):
    lines = [programme(1, MAIN_TITLE='"open'), programme(2, MAIN_TITLE='"closed"'), programme(3)]
    path, clean = write_drop(tmp_path, "d", "F240223A.TXT", lines), write_drop(tmp_path, "d", "F240223B.TXT", lines[1:])
    target, aside = str(tmp_path / "prelog"), str(tmp_path / "aside")
    load = load_files(spark, [path, clean], target, DAY, quote='"', set_aside=aside, strict=True)
    assert (load.loaded_rows, load.nonblank_lines, load.damaged_lines, load.matched) == (4, 5, 1, True)
    assert [(r.file_name, r.value) for r in spark.read.parquet(aside).select("file_name", "value").collect()] == [("F240223A", lines[0])]
    assert {r.MAIN_TITLE for r in read_loaded(spark, target).collect()} == {"closed", "Programme 3"}
    plain = load_files(spark, [path], target, DAY, set_aside=aside)
    assert (plain.loaded_rows, plain.damaged_lines) == (3, 0)
