"""Pigeonhole edit matching: distances and hits against dynamic programming and plain searches, odd rows."""

import random
import re

import pytest

from slotmill.llm import decontaminate as d

SF = "/root/testdata/sf0.01"


def plain_distance(pattern, text):
    """Smallest edit distance between ``pattern`` and any stretch of ``text``, of bytes or of words."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        pattern = bytes(rng.choices(b"ab c", k=rng.randint(1, 90)))
        text = bytes(rng.choices(b"ab c", k=rng.randint(0, 60)))
        if rng.random() < 0.5:
            text += pattern[: rng.randint(0, 90)] + text
        assert d.Pattern(pattern).distance(text) == plain_distance(pattern, text)
        words = text.split(b" ")
        assert d.Pattern(pattern.split(b" ")).distance(words) == plain_distance(pattern.split(b" "), words)


def edited(rng, passage, edits):
    out = bytearray(passage)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(b"xyz")
        elif kind == 1:
            out[at:at] = bytes([rng.choice(b"xyz")])
        else:
            del out[at]
    return bytes(out)


def words(rng, n, least=2, most=9):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(least, most))) for _ in range(n))


def found_in(spark, items, texts):
    """{text number: {item number: row}}"""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    out = {n: {} for n in range(len(texts))}
    for r in d.leaks(docs, bench).collect():
        assert r.item_id not in out[r.doc_id]
        out[r.doc_id][r.item_id] = r
    return out


def test_every_verbatim_run_of_sixteen_words_is_found(spark):
    """At every offset and of every length, in another document; found by a search that only compares words."""
    rng = random.Random(2)
    items = [words(rng, n) for n in (59, 40, 24, 17, 16)]
    texts, holding = [], []
    for number, item in enumerate(items):
        parts = item.split()
        for size in (16, 17, 20, 24, 28, 30, 40):
            for start in range(len(parts) - size + 1):
                texts.append(f"{words(rng, 30)} {' '.join(parts[start : start + size])} {words(rng, 30)}")
                holding.append(number)
    found = found_in(spark, items, texts)
    for n, number in enumerate(holding):
        assert set(found[n]) == {number} and found[n][number].distance == 0, (n, number)
        line = d.normal(texts[n])
        at = found[n][number].start
        assert line[at : at + 30] in d.normal(items[number])


@pytest.mark.parametrize("size", [10, 12, 15, 16, 20, 24, 40])
def test_items_with_one_word_changed_are_found(spark, size):
    rng = random.Random(size)
    items = [words(rng, size, 4, 9) for _ in range(40)]
    texts = []
    for n, item in enumerate(items):
        parts = item.split()
        at = rng.randrange(size)
        change = [[words(rng, 1, 1, 30)], [], [parts[at], words(rng, 1, 1, 30)]][n % 3]
        parts[at : at + 1] = change
        texts.append(f"{words(rng, 20)} {' '.join(parts)}, {words(rng, 20)}")
    found = found_in(spark, items, texts)
    assert [n for n in range(40) if set(found[n]) != {n}] == []


def test_every_passage_within_the_byte_budget_is_found(spark):
    """Runs of 16 and 24 words with as many random edits as allowed, checked by dynamic programming."""
    rng = random.Random(3)
    items = [words(rng, rng.randint(16, 60)) for _ in range(15)]
    texts, planted = [], []
    for n in range(150):
        item = rng.randrange(len(items))
        parts = items[item].split()
        size = min(rng.choice((16, 24)), len(parts))
        start = rng.randrange(len(parts) - size + 1)
        passage = " ".join(parts[start : start + size]).encode()
        edits = rng.randint(0, len(passage) // 16 - 1)
        texts.append(f"{words(rng, 25)} {edited(rng, passage, edits).decode()} {words(rng, 25)}")
        planted.append((item, passage, edits))
    found = found_in(spark, items, texts)
    for n, (item, passage, edits) in enumerate(planted):
        assert item in found[n], (n, edits)
        row = found[n][item]
        # the passage that was found may be another one of the item, but it is no worse than the planted one
        assert row.word_edits or row.distance <= row.budget
        if not row.word_edits:
            assert row.distance <= plain_distance(passage, d.normal(texts[n]))
        for other in set(found[n]) - {item}:
            raise AssertionError((n, other))


def test_shorter_runs_and_other_texts_are_none(spark):
    rng = random.Random(4)
    items = [words(rng, 40) for _ in range(10)]
    texts = [words(rng, 300) for _ in range(30)]
    texts += [f"{words(rng, 20)} {' '.join(i.split()[3:13])} {words(rng, 20)}" for i in items]
    assert not any(found_in(spark, items, texts).values())


def test_short_items(spark):
    items = ["What is the capital of France?", "Yes it is", "a rather short item indeed, no?", "Name the tallest tower"]
    texts = [
        "He asked: what is the capital of France, and why?", "What is the capital of France", "so what is the capital of Frances",
        "yes, it IS!", "oh yes it is", "nowhat is the capital of France", "And a rather short item indeed no other", "Name the tallest tower", "Name the tallest tower here",
    ]
    found = {n: set(hits) for n, hits in found_in(spark, items, texts).items()}
    assert found == {0: {0}, 1: {0}, 2: set(), 3: {1}, 4: set(), 5: set(), 6: {2}, 7: {3}, 8: set()}


def test_all_documents(spark):
    docs = {r.doc_id: d.normal(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: d.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r for r in d.op5_benchmark_decontamination(spark, SF).collect()}

    def runs(line):
        parts = line.split()
        return {b" ".join(parts[i : i + 16]) for i in range(max(1, len(parts) - 15))}

    wanted = {n: runs(item) for n, item in items.items()}
    exact = {(a, b) for a, line in docs.items() for have in [runs(line)] for b, want in wanted.items() if have & want}
    assert exact and exact <= set(found)
    for a, b in set(found) - exact:
        row = found[a, b]
        place = docs[a][max(0, row.start - 60) : row.start + 400]
        spans = [items[b][s:e] for s, e in d.passages(items[b])]
        assert any(
            plain_distance(p, place) <= len(p) // 16 - 1 or plain_distance(p.split(), place.split()) <= 1 for p in spans
        ), (a, b)


def test_odd_rows(spark):
    item = "Seven quick brown foxes jumped over nine lazy dogs, while twelve cats slept near the old mill."
    bench = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "Yes it is"), (None, item), (5, "...")], "item_id long, text string"
    )
    rows = [
        (1, None), (2, ""), (3, f"a b c {item.upper()} d"), (3, f"a b c {item.upper()} d"), (4, "yes, IT is!"),
        (5, "yes it is not"), (None, item), (6, "word " * 300_000 + item.replace("quick", "quack") + " é" * 20_000),
        (7, item[: len(item) // 2]), (8, item.replace(" ", "\n")),
    ]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, distance int, _places string, `a.b` string")
    found = sorted(((r.doc_id, r.item_id, r.distance) for r in d.leaks(docs, bench).collect()), key=str)
    want = [(i, n, 1 if i == 6 else 0) for i in (3, 3, None, 6, 8) for n in (1, None)] + [(4, 4, 0)]
    assert found == sorted(want, key=str)
    clean = d.without_leaks(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 5, 7]
    nothing = bench.filter("false")
    assert d.leaks(docs, nothing).collect() == [] and d.without_leaks(docs, nothing).count() == len(rows)
    assert d.leaks(docs.filter("false"), bench).collect() == []


def test_texts_longer_than_a_span(monkeypatch, spark):
    rng = random.Random(5)
    line = d.normal(words(rng, 400))
    whole = [(start, numbers.tolist()) for start, numbers in d.stretches(line)]
    monkeypatch.setattr(d, "SPAN", 37)
    spans = [(start, numbers.tolist()) for start, numbers in d.stretches(line)]
    assert [n for _, numbers in spans for n in numbers] == whole[0][1] and len(whole[0][1]) == len(line) - 15
    assert all(start == 37 * i for i, (start, _) in enumerate(spans))


def test_documents_are_read_once_whatever_the_benchmark(spark, tmp_path):
    """Only suspects meet the items, in a join; the driver gets the bits of the filter and nothing else."""
    rng = random.Random(6)
    items = [words(rng, 30) for _ in range(300)]
    texts = [words(rng, 100) for _ in range(200)] + [f"{words(rng, 9)} {items[7]} {words(rng, 9)}"]
    bench = d.Benchmark(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = bench.scanned(docs, "text", "places")
    plan = marked.filter("places.line IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    suspects = [r.doc_id for r in marked.filter("places.line IS NOT NULL").collect()]
    assert 200 in suspects and len(suspects) < 10 and re.search("numbers", marked.schema.simpleString())
