"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier over hashed byte
trigrams is learned for each bit, and a text gets the language whose codeword
is nearest to the classifiers' margins under a weighted logistic loss. Two
codewords that are about as near make the answer ambiguous.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import fold, fresh_name, held_out, rounded, table

UNDETERMINED = "und"
BUCKETS = 4096
#: rows that the classifiers are fitted on, dealt evenly to the languages
SAMPLE_ROWS = 4000
#: a runner-up with at least this share of the winner's probability makes a text ambiguous
AMBIGUOUS = 0.5

RESULT = "lang_pred string, score double, runner_up string, ambiguous boolean"
FIELDS = [part.split()[0] for part in RESULT.split(", ")]

#: lower-case ASCII letters and all bytes of other scripts stay, the rest is white space
_PLAIN = np.array([b if b > 127 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def trigrams(text: str) -> np.ndarray:
    """Unit vector of square roots of hashed trigram counts over the whole text."""
    raw = _PLAIN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    raw = raw[keep].astype(np.uint32)
    codes = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    slots = codes * np.uint32(2654435769) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    vector = np.sqrt(np.bincount(slots, minlength=BUCKETS)).astype(np.float32)
    return vector / max(float(np.linalg.norm(vector)), 1e-9)


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """(languages, bits) of -1 and 1: all ways to part up to five languages, else the best of random codes."""
    if languages <= 1:
        return np.ones((languages, 1), np.float32)
    if languages <= 5:
        bits = 2 ** (languages - 1) - 1
        splits = [[1] + [1 if (b >> i) & 1 else -1 for i in range(languages - 1)] for b in range(bits)]
        return np.array(splits, np.float32).T
    bits = math.ceil(10 * math.log2(languages))
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(languages) * bits
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (BUCKETS + 1, bits), the last row is the bias
    trust: np.ndarray  # (languages, bits), rows sum to 1

    def decode(self, vectors: np.ndarray) -> np.ndarray:
        """(texts, languages): probability of each language from its codeword's loss."""
        margins = vectors @ self.weights[:-1] + self.weights[-1]
        loss = np.logaddexp(0.0, -margins[:, None, :] * self.code[None])
        distance = (loss * self.trust[None]).sum(axis=2) * self.code.shape[1]
        likely = np.exp(-(distance - distance.min(axis=1, keepdims=True)))
        return likely / likely.sum(axis=1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float, str | None, bool]:
        if not self.languages or not has_letters(text):
            return UNDETERMINED, 0.0, None, True
        likely = self.decode(trigrams(text)[None])[0]
        order = np.argsort(-likely, kind="stable")
        first = int(order[0])
        if len(order) == 1:
            return self.languages[first], 1.0, None, False
        second = int(order[1])
        close = bool(likely[second] >= AMBIGUOUS * likely[first])
        return self.languages[first], rounded(likely[first]), self.languages[second], close


def fit_codes(vectors: np.ndarray, answers: np.ndarray, languages: tuple[str, ...], rounds: int = 80) -> LanguageModel:
    """One logistic classifier per bit, languages weighing the same; trust is each one's training accuracy."""
    code = codewords(len(languages))
    y = code[answers]
    shares = np.bincount(answers, minlength=len(languages))[answers]
    weight = (1.0 / (len(languages) * shares))[:, None].astype(np.float32)
    w = np.zeros((vectors.shape[1] + 1, code.shape[1]), np.float32)  # the last row is the bias
    speed = np.zeros_like(w)
    for _ in range(rounds):
        pull = weight * y / (1.0 + np.exp(np.clip(y * (vectors @ w[:-1] + w[-1]), -30, 30)))
        slope = 1e-5 * w
        slope[:-1] -= vectors.T @ pull
        slope[-1] -= pull.sum(axis=0)
        speed = 0.9 * speed - 4.0 * slope
        w += speed
    right = (y * (vectors @ w[:-1] + w[-1]) > 0).astype(np.float64)
    trust = np.stack([right[answers == k].mean(axis=0) if (answers == k).any() else np.ones(code.shape[1]) for k in range(len(languages))])
    trust = np.maximum(trust, 1e-3)
    return LanguageModel(languages, code, w, trust / trust.sum(axis=1, keepdims=True))


def learn_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS
) -> LanguageModel:
    """Fit on about ``sample_rows`` rows with a language and letters, as many of each language as there are.

    Rows are chosen by a hash of id and text. Without such rows every text is undetermined.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return LanguageModel((), codewords(0), np.zeros((BUCKETS + 1, 1), np.float32), np.ones((0, 1)))
    share, grain = max(1, sample_rows // len(counts)), 1 << 40
    limits = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, int(grain * min(1.0, share / n)))])
    drawn = F.pmod(F.xxhash64("id", "text", F.lit("language")), F.lit(grain)) < limits[F.col("lang")]

    @pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([_packed(trigrams(t)) if has_letters(t) else None for t in texts], dtype=object)

    drawn_rows = known.filter(drawn).select("lang", vector("text").alias("v")).filter("v IS NOT NULL")
    sample = drawn_rows.limit(2 * sample_rows).collect()
    languages = tuple(sorted({r["lang"] for r in sample}))
    if not languages:
        return LanguageModel((), codewords(0), np.zeros((BUCKETS + 1, 1), np.float32), np.ones((0, 1)))
    sample.sort(key=lambda r: (r["lang"], bytes(r["v"])))  # the same model whatever the order of arrival
    answers = np.array([languages.index(r["lang"]) for r in sample])
    # one dense copy; the packed rows are let go as it fills
    vectors = np.zeros((len(sample), BUCKETS), np.float32)
    for i in range(len(sample) - 1, -1, -1):
        _unpack(sample.pop()["v"], vectors[i])
    return fit_codes(vectors, answers, languages)


def _packed(vector: np.ndarray) -> bytes:
    """The buckets of a vector that are not 0, and their values."""
    used = np.flatnonzero(vector)
    return used.astype(np.uint16).tobytes() + vector[used].astype(np.float16).tobytes()


def _unpack(packed: bytes, vector: np.ndarray) -> None:
    half = len(packed) // 2
    vector[np.frombuffer(packed[:half], np.uint16)] = np.frombuffer(packed[half:], np.float16)


def language_column(text: Column, model: LanguageModel) -> Column:
    @pandas_udf(RESULT)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=FIELDS)

    return of(text.cast("string"))


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` and a struct ``name``: lang_pred, score, runner_up, ambiguous.

    A null text and one without a letter is undetermined (``und``, score 0, ambiguous). Predictions
    depend on the text alone, so repeated rows agree; other columns stay as they are, but one called
    ``name`` is replaced.
    """
    return docs.withColumn(name, language_column(F.col(text_col), model))


def in_known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is determined and not ambiguous, with their columns as they are.

    Null and empty texts and those without a letter go; so does a text between two languages that are about
    as likely. Repeated rows stay or go together, ids and other columns are not looked at and may have any
    names, long texts are read whole, and an empty table stays empty.
    """
    name = fresh_name(docs, "_language")
    return with_language(docs, model, text_col, name).filter(~F.col(f"{name}.ambiguous")).select(docs.columns)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32 of the id modulo 4 is not 2. A null id is of no fold, so its row is left out."""
    return docs.filter(fold(F.col("doc_id"), 4) != 2)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_languages(training_rows(docs))
    found = with_language(docs.drop("lang"), model, name="language")
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2), "language.*")
