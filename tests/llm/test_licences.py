"""Licence scan: bounds never lose a match, known notices, odd rows."""

import random
import re

import pytest

from slotmill.llm import licences as lic

SF = "/root/testdata/sf0.01"


def plain_best(words, templates, least):
    """Best template without any pruning."""
    best = None
    for name in sorted(templates):
        for text in templates[name]:
            a, b = lic.bigrams(lic.normal_words(text)), lic.bigrams(words)
            value = lic.dice(a, b)
            if value >= least and (best is None or value > best):
                best = value
    return best


def test_pruning_loses_nothing():
    rng = random.Random(6)
    scanner = lic.Scanner(lic.TEMPLATES, 0.6)
    pool = [w for texts in lic.TEMPLATES.values() for t in texts for w in lic.normal_words(t)]
    hits = 0
    for _ in range(1500):
        words = lic.normal_words(rng.choice(rng.choice(list(lic.TEMPLATES.values()))))
        for _ in range(rng.randrange(1 + len(words) // 4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(3)] = rng.choices(pool + ["zebra"] * 9, k=rng.randrange(3))
            words = words or ["x"]
        got, want = scanner.best(words), plain_best(words, lic.TEMPLATES, 0.6)
        hits += want is not None
        assert (got is None) == (want is None) and (got is None or abs(got[0] - want) < 1e-12)
    assert hits > 500


def test_full_text_over_several_lines():
    mit = lic.TEMPLATES["MIT"][2]
    words = mit.split()
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    text = f"Intro here.\n\nCopyright (c) 2020 Some One\n{wrapped}\n\nMore text."
    found = lic.Scanner(lic.TEMPLATES, 0.8).scan(text)
    assert [(f["licence"], f["unit"]) for f in found] == [("MIT", "block")] and found[0]["dice"] > 0.99
    assert text[found[0]["start"] : found[0]["end"]].endswith("SOFTWARE.")


def test_all_documents(spark):
    notices = {t[0]: name for name, t in lic.TEMPLATES.items()}
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want |= {(r.doc_id, notices[line]) for line in r.text.split("\n") if line in notices}
    found = lic.op8_licence_scan(spark, SF).collect()
    assert want and want == {(r.doc_id, r.licence) for r in found}
    assert all(0.8 <= r.dice <= 1 for r in found)


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [
        (1, None), (2, ""), (3, "\n\n \n"), (4, line), (4, line), (None, f"a\n  {line.upper()}\nb"), (5, "word " * 60_000 + "\n" + line),
        (6, f"Good morning to all of you. {line} Good night."), (7, "released under a tree"), (8, "License"), (9, "é" * 1000),
    ]
    frame = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, dice double, hit string")
    found = sorted((str(r.doc_id), r.licence, r.unit) for r in lic.licences(frame).collect())
    assert found == [("4", "MIT", "line")] * 2 + [("5", "MIT", "line"), ("6", "MIT", "sentence"), ("None", "MIT", "line")]
    assert lic.licences(frame.filter("false")).collect() == []
    assert lic.licences(frame, templates={}).collect() == []
    texts = dict(rows)
    for r in lic.licences(frame).collect():
        assert re.search("MIT License", texts[r.doc_id][r.start : r.end], re.I)


def scanned(text):
    return [(f["licence"], text[f["start"] : f["end"]]) for f in lic.Scanner(lic.TEMPLATES, 0.8).scan(text)]


def test_runs_over_lines_sentences_and_blocks():
    words = lic.TEMPLATES["MIT"][2].split()
    at = [0, words.index("The"), words.index("THE"), len(words)]
    parts = [" ".join(words[a:b]) for a, b in zip(at, at[1:])]
    mit = "\n\n".join(parts)
    for before, after in (("A library.\n\n", "\n\nUsage: call it."), ("code = 1\n", "\nx = 2"), ("In one paragraph. ", " And more of it.")):
        assert scanned(before + mit + after) == [("MIT", mit)]
    assert scanned(f"Some text that goes on. {' '.join(parts)} Then other things are told.") == [("MIT", " ".join(parts))]
    wrapped = "All of this text is, as you know, released under the\n# MIT License. It goes on\nfor some more lines."
    assert [name for name, _ in scanned(wrapped)] == ["MIT"]
    assert [name for name, _ in scanned("Released under the MIT License. Hello there. Licensed under CC BY 4.0.\n" * 3)] == ["MIT", "CC-BY-4.0"] * 3
    assert scanned("Licensed under CC BY-ND 4.0.") == [] and scanned("This was released under the apple tree.") == []


def test_every_run_of_words_is_looked_at():
    rng = random.Random(3)
    short = {"A": ("one two three four five six seven",), "B": ("one two one two one three",)}
    scanner = lic.Scanner(short, 0.7)
    for _ in range(300):
        words = rng.choices("one two three four five six seven x".split(), k=14)
        grams = {n: lic.bigrams(t[0].split()) for n, t in short.items()}
        want = 0.0
        for name, gram in grams.items():
            n = sum(gram.values())
            for a in range(14):
                for b in range(a + 1, 14):
                    if b - a >= n or (a, b) == (0, 13):
                        want = max(want, lic.dice(lic.bigrams(words[a : b + 1]), gram))
        found = scanner.scan(" ".join(words))
        assert max((f["dice"] for f in found), default=0) == (want if want >= 0.7 else 0)


def test_only_the_copyright_statement_is_left_out():
    for text in (
        "Copyright (c) 2020 Foo Inc. Licensed under the MIT License.",
        "Copyright 2020 Foo and others, licensed under the MIT License.",
        "It is \u00a9 by us, copyright 2020. " + "Words go on. " * 500 + "Licensed under the MIT License. More.",
    ):
        assert [name for name, _ in scanned(text)] == ["MIT"]
    assert lic.normal_words("A copyright 2020 Foo 2.0 B.V. Now on\nCopyright \u00a9 1999-2020 Bar\nend") == ["a", "now", "on", "end"]


def test_full_texts_and_headers_within_a_document():
    scanner = lic.Scanner(lic.TEMPLATES, 0.8)
    for name in lic.TEMPLATES:
        for text in lic.TEMPLATES[name][1:]:
            found = scanner.scan(f"A readme of a project.\n\n{text}\n\nUsage is told here.")
            assert [(f["licence"], round(f["dice"], 9)) for f in found] == [(name, 1.0)], name
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "Unlicense"):
        assert max(len(lic.normal_words(t)) for t in lic.TEMPLATES[name]) > 100


def test_words_of_a_template_over_and_over_are_passed_by():
    """Many hits of few bigrams: no start of a run can reach a template, and none is summed."""
    import time

    scanner = lic.Scanner(lic.TEMPLATES, 0.8)
    phrase = " ".join(lic.normal_words(max(lic.TEMPLATES["GPL-3.0"], key=len))[100:107])
    text = f"{phrase} stop " * 17_500
    started = time.perf_counter()
    assert scanner.scan(text) == [] and len(text.split()) == 140_000
    assert time.perf_counter() - started < 8
    notice = lic.TEMPLATES["MIT"][2]
    assert [f["licence"] for f in scanner.scan(f"{phrase} stop " * 2000 + notice + f" {phrase} stop" * 2000)] == ["MIT"]


def test_the_reach_of_a_start_is_what_its_longest_run_shares():
    rng = random.Random(11)
    for _ in range(25):
        template = tuple(rng.choices("abcdef", k=rng.randint(25, 40)))
        scanner = lic.Scanner({"x": (" ".join(template),)}, 0.8)
        words = rng.choices("abcdefgh", k=rng.randint(30, 120))
        at = rng.randrange(len(words))
        words[at:at] = list(template[: rng.randint(20, len(template))])
        doc = lic.Words(" ".join(words), scanner.known)
        doc.place()
        n, _, grams = scanner.rows[0]
        best = 0.0
        for a in range(len(words)):
            for b in range(a + 1, len(words)):
                best = max(best, lic.dice(lic.bigrams(words[a : b + 1]), grams))
        found = [value for value, _, _ in scanner._windows(0, doc, 0, len(doc.pairs))]
        assert (max(found) if found else 0.0) == (pytest.approx(best) if best >= 0.8 - 1e-12 else 0.0)
