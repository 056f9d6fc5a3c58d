from datetime import date

import pytest
from helpers import programme, write_drop

from slotmill import fixed
from slotmill.errors import DuplicateFileId, MissingInput, NoDayFolder
from slotmill.sources import landing


@pytest.fixture
def root(tmp_path):
    root = tmp_path / "landing area"
    for name in ("F240223A.TXT", "F240223B.TXT", "F240131Z.TXT", "G240223A.TXT", "F240223AA.TXT", "f240224A.TXT"):
        write_drop(root, "2024-02-26", name, [programme(1)])
    write_drop(root, "2024-02-19", "F240223C.TXT", [programme(1)])
    write_drop(root, "2023-12-29", "F231229A.TXT", [programme(1)])
    write_drop(root, "2024-02-26/F24nested", "F240301A.TXT", [programme(1)])
    (root / "2024-notes.txt").write_text("a file, not a folder")
    return str(root)


def test_entries_list_files_and_folders(spark, root):
    rows = {(r.name, r.is_folder) for r in landing.landing_entries(spark, root).collect()}
    assert rows == {("2024-02-26", True), ("2024-02-19", True), ("2023-12-29", True), ("2024-notes.txt", False)}


def test_missing_root_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.find_latest_drop(spark, str(tmp_path / "absent"))


def test_newest_version_of_newest_folder(spark, root):
    drop = landing.find_latest_drop(spark, root)
    assert (drop.file, drop.file_id, drop.folder) == ("F240223B.TXT", "F240223B", date(2024, 2, 26))
    assert landing.find_latest_drop(spark, root, "2024", "F24", id_length=7).file_id == "F240223"
    assert drop.path.endswith("/2024-02-26/F240223B.TXT")


def test_day_first_reading_picks_another_file(spark, root):
    drop = landing.find_latest_drop(spark, root, date_pattern=fixed.FILE_DATE_PATTERN_DAY_FIRST)
    assert drop.file == "F240131Z.TXT"


def test_year_prefix_is_a_parameter(spark, root):
    drop = landing.find_latest_drop(spark, root, year_prefix="2023", file_prefix="F23")
    assert drop.file == "F231229A.TXT"


def test_no_folder_of_the_year(spark, root):
    with pytest.raises(NoDayFolder):
        landing.find_latest_drop(spark, root, year_prefix="2031")


def test_unparseable_folder_fails(spark, root, tmp_path):
    (tmp_path / "landing area" / "2024-bad").mkdir()
    with pytest.raises(Exception, match="not a folder date: 2024-bad"):
        landing.find_latest_drop(spark, root, year_prefix="2024")
    assert landing.find_latest_drop(spark, root).file == "F240223B.TXT"


def test_any_year_without_prefixes(spark, root):
    write_drop(root, "2026-11-30", "F261129A.TXT", [programme(1)])
    write_drop(root, "2026-11-30", "Final notes.TXT", [programme(1)])
    assert landing.find_latest_drop(spark, root).file == "F261129A.TXT"


def test_a_newest_version_without_bytes_is_seen(spark, root):
    write_drop(root, "2024-02-26", "F240224A.TXT", [])
    assert landing.find_latest_drop(spark, root).file == "F240224A.TXT"


def test_newest_folder_without_match_is_missing_input(spark, root):
    write_drop(root, "2024-03-11", "G240308A.TXT", [programme(1)])
    with pytest.raises(MissingInput, match="2024-03-11"):
        landing.find_latest_drop(spark, root)


def test_empty_newest_folder_is_missing_input(spark, root, tmp_path):
    (tmp_path / "landing area" / "2024-03-18").mkdir()
    with pytest.raises(MissingInput, match="2024-03-18"):
        landing.find_latest_drop(spark, root)


def test_unparseable_file_date_fails_or_sorts_last(spark):
    files = spark.createDataFrame([("F24notes.TXT",), ("F240223A.TXT",)], "file string")
    with pytest.raises(Exception, match="not a file name date"):
        landing.newest_version(files).collect()
    assert landing.newest_version(files, strict=False).first().latest_file == "F240223A.TXT"


def test_versions_compare_as_text(spark):
    files = spark.createDataFrame([(f"F240223{v}.TXT",) for v in ("A", "AA", "AZ", "B", "")], "file string")
    assert landing.newest_version(files).first().latest_file == "F240223B.TXT"


def test_shared_ids(spark):
    files = spark.createDataFrame([("F240223A.TXT",), ("F240223AA.TXT",), ("F240223B.TXT",)] * 2, "file string")
    assert [tuple(r) for r in landing.shared_file_ids(files, id_length=8).collect()] == [("F240223A", 2)]
    with pytest.raises(DuplicateFileId, match="F240223A"):
        landing.require_distinct_ids(files, id_length=8)
    landing.require_distinct_ids(files)
