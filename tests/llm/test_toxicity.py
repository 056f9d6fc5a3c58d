"""Multiple-instance toxicity: held-out accuracy, located sentences, odd rows."""

import random
import zlib

import numpy as np

from slotmill.llm import toxicity as tox

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = tox.op7_toxicity(spark, SF).collect()
    assert len(found) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(0 <= s.start < s.end <= len(texts[r.doc_id]) for r in found for s in r.spans)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.93 * len(held)


def made(rng, n):
    plain = ["Tree", "house", "river", "stone", "cloud", "bread", "window", "garden"]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choices(plain, k=6)) + "." for _ in range(rng.randint(1, 9))]
        y = int(rng.random() < 0.3)
        at = rng.randrange(len(lines))
        if y:
            lines[at] = lines[at][:-1] + " " + rng.choice(["grumble", "Snarl"]) + "."
        rows.append((i, " ".join(lines), y, lines[at]))
    return rows


def test_the_sentence_is_found_from_document_labels(spark):
    rows = made(random.Random(4), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:600]], "doc_id long, toxic int")
    model = tox.learn_toxicity(docs, labels)
    score = model.scorer()
    for _, text, y, line in rows[600:]:
        s, spans = score(text)
        assert (s >= 0.5) == bool(y)
        if y:
            assert [text[a:b].strip() for a, b, _ in spans] == [line]


def test_noisy_or():
    weights = np.zeros(tox.BUCKETS, np.float32)
    model = tox.ToxicModel(weights, -1.0)
    p = 1 / (1 + np.exp(1.0))
    s, _ = model.scorer()("One. Two! Three?")
    assert abs(s - (1 - (1 - p) ** 3)) < 1e-6


def test_sentences_are_the_whole_text():
    for text in ("", "a", "a. b", "..!\n\nx y", "\nİstanbul. ok\n", "." * 9):
        spans = tox.sentences(text)
        assert "".join(text[a:b] for a, b in spans) == text


def test_odd_rows(spark):
    texts = [None, "", " \n", "word", "İİİ. grumble İ!", "ok words. " * 20_000, "." * 300]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "a", 2), (1, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, Toxicity int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (None, 1), (77, 1), (4, None)], "doc_id long, toxic int")
    for known in (labels, labels.filter("false"), labels.filter("toxic = 0")):
        model = tox.learn_toxicity(frame, known)
        out = tox.with_toxicity(frame, model, name="toxicity")
        assert out.count() == len(rows)
        got = {(r.doc_id, r.text): r.toxicity.score for r in out.collect()}
        assert got[0, None] == got[1, ""] == 0 and all(0 <= s <= 1 for s in got.values())
    empty = frame.filter("false")
    assert tox.with_toxicity(empty, tox.learn_toxicity(empty, labels)).collect() == []
