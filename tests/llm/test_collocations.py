from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotmill.llm import collocations as co


def plain(rows, min_count, top=2000):
    """Every phrase listed with its count, then the rules as they are stated."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= min_count}
        inside = Counter()
        for longer, a in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    part = longer[i : i + k]
                    inside[part] = max(inside[part], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, cut = min((int(Fraction(1000 * a * totals[lang], f[p[:c]] * f[p[c:]])), c) for c in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "text string, lang string")
    return sorted(map(tuple, co.collocations(frame, **options).collect()))


def corpus():
    rng = random.Random(3)
    words = ["The", "the", "red", "fox", "é", "a\x01", "a", "of", "b c", "x-y", "Über"]
    rows = []
    for i in range(120):
        signs = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ? "]
        text = "".join(rng.choice(words[: 3 + i % 9]) + rng.choice(signs) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", None), ("...", "en"), ("one", "fr"), rows[0], rows[0]]
    rows.append(("a a a a a a a a " * 40, "fr"))
    rows.append(("w" * 5000 + " the red fox " * 300, "en"))
    return rows


@pytest.mark.parametrize("options", [{}, {"budget": 3, "held_words": 50}])
def test_equals_a_plain_count(spark, options):
    rows = corpus()
    got = found(spark, rows, min_count=4, **options)
    assert got == plain(rows, 4) and len({r[0] for r in got}) > 3


def test_first_of_each_language(spark):
    rows = corpus()
    assert found(spark, rows, min_count=3, top=5) == plain(rows, 3, 5)


def test_nothing_to_find(spark):
    assert found(spark, []) == [] and found(spark, [(None, None), ("a b a b", "en")]) == []


def test_other_columns(spark):
    frame = spark.createDataFrame([("a b " * 9, "en", 1, "x")], "text string, lang string, score int, PHRASE string")
    assert {r.phrase for r in co.collocations(frame, min_count=8).collect()} == {r[2] for r in plain([("a b " * 9, "en")], 8)}


def test_scores_beyond_64_bits(spark):
    n, a, l, r = 9 * 10**15, 10**15, 3 * 10**15, 1000000000000007
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    phrases = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r)], "lang string, phrase string, k int, f long")
    row = co.scored(totals, phrases).first()
    assert row.score == 1000 * a * n // (l * r) and (row.l, row.r) == (l, r)


@pytest.mark.parametrize("span", [1, 2, 7, 1000])
def test_spans_do_not_change_the_words(span):
    text = "Ab cd.Ef\tgh  i, jklmnopqrst\n\nu v".encode()
    words = [w for part in co.split_words(text, span) for w in part if w]
    assert words == b"ab cd \n ef gh i \n jklmnopqrst \n \n u v".split(b" ")


def test_the_filter_has_every_phrase(spark):
    phrases = [("en", "a"), ("en", "a b"), ("de", "é")] + [("en", str(i)) for i in range(2000)]
    bits = co.Filter.of_words(spark.createDataFrame(phrases, "lang string, phrase string"))
    for lang, phrase in phrases:
        ids = co.Ids(lang.encode(), bits)
        assert ids[phrase.encode()] > 0
    wrong = sum(co.Ids(b"en", bits)[f"no {i}".encode()] > 0 for i in range(2000))
    assert wrong < 5


@pytest.mark.parametrize("held_words", [20, 1 << 20])
def test_every_frequent_pair_has_its_place(spark, held_words):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    text = " ".join(words[min(int(rng.expovariate(0.2)), 39)] for _ in range(4000))
    docs = spark.createDataFrame([("en", t) for t in text.split("w7 ")] + [("de", "w1 w2 " * 3)], "lang string, text string").repartition(5)
    every = co.Filter.of_words(spark.createDataFrame([(lang, w) for lang in ("en", "de") for w in words], "lang string, phrase string"))
    found = co.frequent_pairs(docs, every, 6, held_words)
    counts = Counter()
    for lang, part in docs.collect():
        tokens = part.split()
        counts.update((lang, a, b) for a, b in zip(tokens, tokens[1:]))
    wrong = 0
    for lang in ("en", "de"):
        ids = co.Ids(lang.encode(), every)
        for a in words:
            for b in words:
                numbers = np.array([ids[a.encode()], ids[b.encode()]])
                known = bool(found.has_places(co._pairs(ids, numbers)[1])[0])
                assert known or counts[lang, a, b] < 6
                wrong += known and counts[lang, a, b] < 6
    assert wrong <= 2 and max(counts.values()) > 20


def test_groups_keep_to_the_budget(spark):
    rows = [("en", f"a b {i} {j}", 1) for i in range(6) for j in range(40)] + [("en", f"{i} x", 2) for i in range(50)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, f long")
    grouped = co.vertical_groups(frame, 30)
    sizes = {(r.lot, r.number): r["count"] for r in grouped.groupBy("lot", "number").count().collect()}
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) < 60
    assert {r.depth for r in grouped.filter(F.col("phrase").startswith("a b")).collect()} == {4}
