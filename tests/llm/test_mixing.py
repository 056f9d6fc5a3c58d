from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotmill.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def texts(seed=1, sources=("b", "a", "c", None, "é"), documents=400):
    rng = random.Random(seed)
    rows = []
    for i in range(documents):
        source = sources[min(int(rng.expovariate(0.8)), len(sources) - 1)]
        rows.append((i, "w " * int(rng.lognormvariate(3, 1.2)), source))
    return rows


def words_of(text):
    return len((text or "").encode().split())


def targets(rows, weights=(5, 2, 1), most=3):
    """Shares by weight with what is beyond the most copies dealt out again."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words_of(text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    out, total, open_ = {}, Fraction(sum(sizes.values())), set(order)
    while open_:
        share = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > most * sizes[s]}
        if not over:
            out.update({s: weight[s] * share for s in open_})
            break
        out.update({s: Fraction(most * sizes[s]) for s in over})
        open_ -= over
    return sizes, {s: float(t) for s, t in out.items()}


def mix(spark, rows, **options):
    return mixing.mixed(spark.createDataFrame(rows, SCHEMA), **options).collect()


@pytest.mark.parametrize("seed,sources", [(1, ("b", "a", "c", None, "é")), (2, ("x", "y")), (3, ("only",)), (4, tuple("abcdefghij"))])
def test_targets_and_words_taken(spark, seed, sources):
    rows = texts(seed, sources)
    sizes, wanted = targets(rows)
    got = mix(spark, rows)
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    taken = {}
    for r in got:
        source, words = rows[r.doc_id][2], words_of(rows[r.doc_id][1])
        assert (r.size, r.source_size) == (words, sizes[source]) and r.target == pytest.approx(wanted[source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size and abs(r.copies - r.rate) < 2
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= 5


def test_rates_are_exponentials_of_the_size_that_meet_the_constraint(spark):
    rows = texts(5, ("a", "b", "c"))
    _, wanted = targets(rows)
    by_source = {}
    for r in mix(spark, rows):
        by_source.setdefault(r.source, []).append(r)
    tilted = 0
    for source, found in by_source.items():
        assert sum(r.rate * r.size for r in found) == pytest.approx(wanted[source], rel=1e-5)
        free = [(r.size, math.log(r.rate)) for r in found if r.size and r.rate < 3]
        if free:
            slope = {log / size for size, log in free}
            assert max(slope) - min(slope) < 1e-9 * max(1, max(map(abs, slope)))
            tilted += max(map(abs, slope)) > 0
        # nothing nearer to one meets the constraint: a plain search for the unknown finds the same rates
        low, high = -1.0, 1.0
        for _ in range(200):
            middle = (low + high) / 2
            words = sum(r.size * min(3.0, math.exp(min(middle * r.size, 2))) for r in found)
            low, high = (middle, high) if words < wanted[source] else (low, middle)
        for r in found:
            if wanted[source] < 3 * r.source_size:
                assert r.rate == pytest.approx(min(3.0, math.exp(min(low * r.size, 2))), rel=1e-4, abs=1e-9)
    assert tilted >= 2


def test_rounding_carries_what_is_left_over():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 500, 300))[::-1]
    rates = rng.random(300) * 3
    copies = mixing.carried(sizes, rates, np.ones(300, np.int64))
    assert ((copies >= np.floor(rates)) & (copies <= np.ceil(rates))).all()
    assert abs((copies * sizes).sum() - (rates * sizes).sum()) <= 5
    # small documents that are wanted once almost surely cannot make up for a large one that was left out
    sizes, rates = np.array([90, 20, 10, 5, 5]), np.array([0.45, 0.95, 0.95, 0.95, 0.95])
    copies = mixing.carried(sizes, rates, np.ones(5, np.int64))
    assert abs((copies * sizes).sum() - (rates * sizes).sum()) <= 5 and copies.max() <= 2
    assert mixing.carried(np.array([0, 0]), np.array([1.0, 2.5]), np.array([1, 2])).tolist() == [1, 5]


def test_small_lots_and_layouts_agree(spark):
    rows = texts(6)
    frame = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, mixing.mixed(frame.repartition(7, "text"), lot_rows=40).drop("source").collect()))
    two = sorted(map(tuple, mixing.mixed(frame.orderBy(F.desc("doc_id")).coalesce(1), lot_rows=40).drop("source").collect()))
    assert one == two


def test_odd_rows(spark):
    assert mix(spark, []) == []
    rows = [(1, None, None), (None, "a b", "x"), (None, "a b", "x"), (2, "", "x"), (3, "\x1c a b", "y"), (3, "a " * 3000, "x")] + [(7, "c d", "z")] * 500
    got = mix(spark, rows)
    sizes, wanted = targets(rows)
    assert len(got) == len(rows) and sorted(r.size for r in got if r.source == "y") == [2]
    for source in ("x", "y", "z"):
        assert all(r.target == pytest.approx(wanted[source]) for r in got if r.source == source)
    taken = sum(r.taken for r in got if r.source == "z")
    assert abs(taken - wanted["z"]) <= 2 and len({r.copies for r in got if r.source == "z"}) <= 2
    assert [r.taken for r in got if r.source is None] == [0]
    assert all(r.taken == 0 for r in mix(spark, [(1, None, "a"), (2, " ", "b")]))


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", "s", 1, 2.0, "x")], SCHEMA + ", size int, rate double, S string")
    assert [(r.doc_id, r.taken) for r in mixing.mixed(frame).collect()] == [(1, 3)]


def test_hot_equal_rows_are_written_in_blocks(spark):
    planned = spark.createDataFrame([("a", 200_000, 300_001)], "id string, repeats long, all_copies long")
    rows = mixing.repeated(planned).groupBy("copies").count().collect()
    assert {(r.copies, r["count"]) for r in rows} == {(1, 99_999), (2, 100_001)}
