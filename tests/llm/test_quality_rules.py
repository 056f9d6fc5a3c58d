"""Quality rules: base measures against a plain count, EM on planted votes, odd rows."""

import random
import re
from collections import Counter

import pytest

from slotmill.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    earlier, dups = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dups += line in earlier
            earlier.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    base = (len(words), sum(map(len, words)), symbols, dups, len(inside))
    return base if words else (0,) * 5


ODD = [
    None, "", " \n\t", "one", "a b a b a b", "x\n\nx\n x\nx", "É # ## é é \x1c y\x85z",
    "a b c\r\na b c\r\na b c\r\n", "#*$%&|<>", "word " * 70_000, "# |",
]


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_base_of_odd_texts(text):
    # symbols of a text without words cannot be: a symbol is a word
    assert q.profile(text)[:5] == plain(text)


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = q.op10_quality_rules(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(texts)
    right = wrong = 0
    for r in found:
        base = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r.kept and r.base_failed)
        if not r.base_failed and r.doc_id in labels:
            right += r.kept == bool(labels[r.doc_id])
            wrong += r.kept != bool(labels[r.doc_id])
    assert right > 50 * wrong


def test_em_finds_which_rules_to_trust():
    rng = random.Random(3)
    accuracy = (0.97, 0.9, 0.9, 0.52)
    rows = []
    for _ in range(20_000):
        y = rng.random() < 0.8
        votes = tuple(0 if rng.random() < 0.3 else (1 if (rng.random() < a) == y else -1) for a in accuracy)
        rows.append((y, votes))
    model = q.fit_votes(Counter(v for _, v in rows), 4)
    weight = [o[1] - o[-1] for o in model.odds]
    assert weight[0] > weight[1] > weight[3] and weight[2] > weight[3]
    hits = sum((model.bias + sum(o[v] for o, v in zip(model.odds, votes)) > 0) == y for y, votes in rows)
    assert hits / len(rows) > 0.93
    assert q.fit_votes({}, 2).bias == 0.0


def test_odd_rows_and_clashing_columns(spark):
    rows = [(i, t, "kept", i, 1.0) for i, t in enumerate(ODD)] + [(None, "w " * 60, None, None, None), (1, "", "", 1, 1.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string, _quality int, quality double")
    found = q.judged(frame, name="verdict")
    assert found.columns == [*frame.columns, "verdict"]
    got = {(r.doc_id, r.text): r.verdict for r in found.collect()}
    for i, text in enumerate(ODD):
        assert tuple(got[i, text])[:5] == plain(text)
    assert found.count() == len(rows)
    assert q.well_made(frame).columns == frame.columns
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert q.judged(empty).collect() == [] and q.well_made(empty).collect() == []
