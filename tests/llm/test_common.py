"""Shared helpers."""

import zlib

from pyspark.sql import functions as F

from slotmill.llm import common


def test_folds_of_ids(spark):
    ids = [None, 0, 1, -7, 123456789012, 42]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = {r.doc_id: r for r in frame.select("doc_id", common.fold(F.col("doc_id"), 5).alias("f"), common.held_out(F.col("doc_id"), 5, 0)).collect()}
    for i in ids:
        want = None if i is None else zlib.crc32(str(i).encode()) % 5
        assert (found[i].f, found[i].held_out) == (want, want == 0)


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(5000).withColumn("same", F.lit(1))
    key = F.col("id")
    picked = {r.id for r in common.bounded_sample(rows, 500, key).collect()}
    assert 300 < len(picked) < 700 and picked == {r.id for r in common.bounded_sample(rows, 500, key).collect()}
    assert common.bounded_sample(rows, 5000, key).count() == 5000
    assert common.bounded_sample(rows, 100, F.col("same")).count() in (0, 200)  # repeated rows go together, to the bound
    assert common.bounded_sample(rows.filter("false"), 10, key).count() == 0


def test_fresh_names(spark):
    frame = spark.createDataFrame([(1, 2)], "_id int, _ID_1 int")
    assert common.fresh_name(frame, "_id") == "_id_2" and common.fresh_name(frame, "x") == "x"


def test_materialised_rows_are_the_same(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, "é")], "a long, b string")
    assert sorted(common.materialise(frame, "test").collect(), key=str) == sorted(frame.collect(), key=str)
