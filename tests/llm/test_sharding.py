"""Histogram sort: shards of equal bytes, gapless slots, ties, odd rows."""

import random
import zlib

import pytest

from slotmill.llm import sharding

SCHEMA = "doc_id long, text string"


def verify(rows, found, shards, tolerance=sharding.TOLERANCE):
    assert len(found) == len(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=key)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=key) == want
    total, biggest = sum(r.size for r in found), max((r.size for r in found), default=0)
    for shard in range(shards):
        inside = [r for r in found if r.shard == shard]
        assert sorted(r.slot for r in inside) == list(range(len(inside)))
        assert abs(sum(r.size for r in inside) - total / shards) <= biggest + 2 * tolerance * total / shards + 1
    assert {r.law for r in found} <= {"bytes"} and {r.grown_shard for r in found} <= {None}
    # key order goes on from shard to shard, so groups of equal texts are neighbours
    order = [r.text_crc32 for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    runs = 1 + sum(a != b for a, b in zip(order, order[1:]))
    assert not order or runs == len(set(order))


@pytest.mark.parametrize("part_bytes", [sharding.PART_BYTES, 40_000])
def test_all_documents(spark, part_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    verify([tuple(r) for r in docs.collect()], sharding.shards(docs, 16, part_bytes=part_bytes).collect(), 16)


def test_a_third_of_all_rows_are_one_row(spark):
    rng = random.Random(3)
    rows = [(7, "the same text")] * 4000 + [(i, "x" * rng.randint(0, 40)) for i in range(8000)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    verify(rows, sharding.shards(frame, 16).collect(), 16)


def test_odd_rows(spark):
    rows = [(None, None), (None, None), (1, None), (1, ""), (2, "é" * 50_000), (2, "b"), (3, "\x00"), (-5, "b"), (-5, "b")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS k1", "2 AS Size", "3 AS part")
    for shards in (1, 2, 16):
        verify(rows, sharding.shards(frame, shards).collect(), shards)
    empty = sharding.shards(spark.createDataFrame([], SCHEMA), 16)
    assert empty.collect() == [] and empty.columns[4] == "shard"
    assert [r.shard for r in sharding.shards(spark.createDataFrame([(1, "a")], SCHEMA), 16).collect()] in ([0], [7], [8], [15])


def test_keys_keep_their_order():
    keys = [(-5, 3, 0), (-5, 3, 1), (-5, 4, -9), (0, 0, 0), (2**63 - 1, -(2**63), 5)]
    assert [sharding.parted(sharding.joined(k)) for k in keys] == keys
    assert sorted(map(sharding.joined, keys)) == list(map(sharding.joined, keys))
