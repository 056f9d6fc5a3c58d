"""Positive-unlabelled learning: prior, risk, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from slotmill.llm import quality_pu as pu

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = pu.op4_quality_classifier(spark, SF).collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_and_scores_without_negatives(share):
    rng = np.random.default_rng(1)
    good = lambda n: rng.normal(1.5, 1, (n, 3))
    bad = lambda n: rng.normal(-1.5, 1, (n, 3))
    n = 6000
    unlabelled = np.concatenate([good(int(n * share)), bad(n - int(n * share))])
    model = pu.fit_pu(good(3000), rng.permutation(unlabelled))
    assert abs(model.prior - share) < 0.06
    assert (model.score(good(1000)) > 0.5).mean() > 0.95 and (model.score(bad(1000)) < 0.5).mean() > 0.9


def test_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(2)
    p, u = rng.normal(0, 1, (30, 40)), rng.normal(0, 1, (60, 40))
    model = pu.fit_pu(p, u, prior=0.6, rounds=2000)
    g = lambda x: pu.standard(x, model.mean, model.scale) @ model.weights + model.bias
    assert np.logaddexp(0, g(u)).mean() - 0.6 * np.logaddexp(0, g(p)).mean() > -0.05


def test_odd_rows(spark):
    texts = [None, "", " \n", "word", "#" * 50, "ok words here. " * 20_000, "É\x1c"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "a", 2, "y"), (1, "", 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, Score int, predicted string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (5, 1), (None, 1), (77, 1), (4, None)], "doc_id long, quality int")
    model = pu.learn_quality(frame, labels)
    out = pu.with_quality(frame, model)
    got = {(r.doc_id, r.text): (r.score, r.predicted) for r in out.collect()}
    assert out.count() == len(rows) and got[0, None] == got[1, ""]
    assert all(0 <= s <= 1 for s, _ in got.values())
    empty, none = spark.createDataFrame([], frame.schema), spark.createDataFrame([], labels.schema)
    blank = pu.learn_quality(empty, none)
    assert pu.with_quality(empty, blank).collect() == []
    assert {r.score for r in pu.with_quality(frame, blank).collect()} == {0.5}
