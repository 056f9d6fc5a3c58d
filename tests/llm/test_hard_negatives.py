from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotmill.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor=lambda i: i % 5 == 0, positives=5, negatives=3):
    """Every anchor against every row, with Python integers."""
    sound = [
        (i, y, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, y, v in sound:
        if not is_anchor(i):
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in sound if j != i and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for score, j, _ in [s for s in scores if s[2] == y][:positives]:
            fits = [s for s in scores if s[2] != y and 50 * score <= 100 * s[0] <= 95 * score][:negatives]
            out += [(i, j, rank, other, score, found) for rank, (found, other, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 5 == 0, **options).collect()))


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 2), (2, 1)])
def test_the_curve_visits_every_cell_by_steps_of_one(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    key = hn.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_bounds_hold_for_all_vectors_of_a_block():
    rng = np.random.default_rng(1)
    anchors, block = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (50, 6))
    low, high = hn.bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = hn.product(anchors, block)
    assert (low[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high[:, 0]).all()


def test_products_beyond_doubles_are_exact():
    a = np.array([[2.0**40, 1.0]])
    b = np.array([[2.0**40, 1.0]])
    assert hn.product(a, b)[0, 0] == 2**80 + 1


def test_equals_brute_force_with_hot_vectors_and_odd_rows(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(300):
        vector = centres[0] if i % 3 == 0 else centres[i % 4] + rng.normal(size=6) / 2
        rows.append((i, [float(np.float32(x)) for x in vector], int(rng.integers(3))))
    rows += [
        (None, [1.0] * 6, 1),
        (1000, None, 1),
        (1005, [1.0] * 6, None),
        (1010, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
        (1015, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0], 1),
        (1020, [1.0, float("inf"), 1.0, 1.0, 1.0, 1.0], 1),
        (1025, [], 1),
        (1030, [0.5, 0.5], 1),
        (1031, [0.5, 0.25], 1),
        (1032, [0.5, 0.125], 2),
        (1035, [0.0] * 6, 2),
    ]
    for options in ({}, {"block_rows": 7, "part_rows": 4, "sample_rows": 20}):
        assert mined(spark, rows, **options) == brute(rows)


def test_few_rows_and_other_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    frame = spark.createDataFrame([(0, [1.0], 1, 5), (1, [1.0], 1, 5), (2, [0.75], 2, 5)], SCHEMA + ", score int")
    assert list(map(tuple, hn.hard_negatives(frame, F.col("id") % 5 == 0).collect())) == [(0, 1, 1, 2, 65536, 49152)]


def test_blocks_that_cannot_matter_are_not_wanted(spark):
    far = [(i, [-1.0 - i / 100, 0.0], 1) for i in range(1, 200)]
    near = [(1000 + i, [1.0 + i / 100, 0.5], 1) for i in range(50)]
    rows = spark.createDataFrame([(i, y, v, int(v[0] * 100)) for i, v, y in far + near], "id long, label long, vector array<float>, key long")
    found = hn.blocks(rows, 10).toPandas()
    windows = [{"at": 0, "w": 0, "least": hn.LEAST + 1, "most": hn.MOST, "last": 1 << 16, "last_id": hn.MOST}]
    anchor = hn.packed([0], [1], [np.array([1.0, 0.0])]) | {"windows": windows}
    low, high = (np.vstack([np.frombuffer(raw) for raw in found[side]]) for side in ("low", "high"))
    wanted = hn.Anchors(type("Row", (), anchor)).wants(low, high, found["least_id"].to_numpy())[0]
    assert wanted.tolist() == [np.frombuffer(raw, np.int64).max() >= 1000 for raw in found["ids"]] and 0 < wanted.sum() < 10
