"""Language codes: held-out accuracy, code distances, odd rows."""

import zlib

import numpy as np
import pytest

from slotmill.llm import language as lang

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = lang.op1_language_id(spark, SF).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 9, 40])
def test_codewords_are_apart(languages):
    code = lang.codewords(languages)
    assert set(np.unique(code)) == {-1, 1}
    apart = [(code[i] != code[j]).sum() for i in range(languages) for j in range(i)]
    assert min(apart) >= (1 if languages == 2 else 2)
    assert (np.abs(code.sum(axis=0)) < languages).all()  # every classifier has both answers


def test_one_wrong_bit_is_corrected():
    code = lang.codewords(4)
    weights = np.zeros((lang.BUCKETS + 1, code.shape[1]), np.float32)
    for flipped in range(code.shape[1]):
        for k in range(4):
            margins = 4 * code[k].copy()
            margins[flipped] *= -1
            weights[-1] = margins
            model = lang.LanguageModel(("a", "b", "c", "d"), code, weights, np.full(code.shape, 1 / code.shape[1]))
            assert model.decode(np.zeros((1, lang.BUCKETS), np.float32))[0].argmax() == k


ROWS = (
    [(i, f"the cat and the dog are here with number {i}", "en") for i in range(40)]
    + [(100 + i, f"die Katze und der Hund sind hier mit Nummer {i}", "de") for i in range(40)]
    + [(200, None, "en"), (201, "", "de"), (202, "123 !!", "en"), (203, "the dog", None), (None, "der Hund und die Katze", "de")]
    + [(204, "x", "en"), (204, "x", "en"), (205, "der Hund und " * 20_000, "de"), (206, "你好", None)]
)


def test_odd_rows(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "2 AS Lang_Pred")
    model = lang.learn_languages(frame)
    assert model.languages == ("de", "en")
    out = lang.with_language(frame, model)
    assert out.columns == [*frame.columns, "language"] and out.count() == len(ROWS)
    got = {(r.doc_id, r.text): r.language for r in out.collect()}
    for doc in ((200, None), (201, ""), (202, "123 !!")):
        assert got[doc].lang_pred == "und" and got[doc].score == 0 and got[doc].ambiguous
    assert got[203, "the dog"].lang_pred == "en"
    assert got[None, "der Hund und die Katze"].lang_pred == "de"
    assert got[205, "der Hund und " * 20_000].lang_pred == "de"
    kept = lang.in_known_language(frame, model)
    assert kept.columns == frame.columns
    assert {200, 201, 202}.isdisjoint(r.doc_id for r in kept.collect())


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = lang.learn_languages(empty)
    assert lang.with_language(empty, model).collect() == []
    one = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert lang.with_language(one, lang.learn_languages(one)).first().language.lang_pred == "und"
    alone = spark.createDataFrame([(1, "abc", "en"), (2, "zzz", None)], "doc_id long, text string, lang string")
    assert {r.language.lang_pred for r in lang.with_language(alone, lang.learn_languages(alone)).collect()} == {"en"}
