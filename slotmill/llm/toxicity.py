"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a chance of being toxic
from its words, and a document is toxic if any of its sentences is: the chances
meet in a noisy-or. Only documents have labels; the sentences' chances follow
from fitting the noisy-or to them, and then show where the trouble is.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import bounded_sample, fold, held_out, rounded, table

BUCKETS = 1 << 18
#: documents with a label that the model is fitted on, and the bytes of their texts
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 64_000_000
THRESHOLD = 0.5
#: a sentence with this chance or more is reported
OFFENDING = 0.3
#: buckets met in fewer documents are not learned
LEAST_DOCS = 5
DECAY = 3e-5
#: toxic documents weigh more than others by no more than this
BOOST = 3.0
#: what a word's log odds in labelled documents count as its first weight
HEAD_START = 2.0
#: word scores that a task keeps at hand before it starts anew
REMEMBERED = 500_000

#: a sentence ends after . ! ? or at a line's end
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
WORD = re.compile(r"\w+")


def word_slots(word: str) -> tuple[int, int]:
    """Buckets of a word and of its beginning, which stands for its other forms."""
    raw = word.encode("utf-8", "replace")
    start = word[:5].encode("utf-8", "replace")
    return zlib.crc32(raw) % BUCKETS, zlib.crc32(start, 77) % BUCKETS


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences; together they are the whole text."""
    return [m.span() for m in SENTENCE.finditer(text)]


@dataclass(frozen=True)
class ToxicModel:
    weights: np.ndarray  # one per bucket
    bias: float

    def scorer(self):
        """Function text -> (score, [(start, end, chance)] of offending sentences)."""
        known: dict[str, float] = {}
        weights, bias = self.weights, self.bias

        def weigh(word: str) -> float:
            value = known.get(word)
            if value is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                a, b = word_slots(word)
                value = known[word] = float(weights[a] + weights[b])
            return value

        def score(text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
            if not text:
                return 0.0, []
            lowered = text.lower()
            if len(lowered) != len(text):  # a few capitals have two-letter small forms; spans must stay
                lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
            spans = sentences(lowered)
            z = np.array([sum(map(weigh, set(WORD.findall(lowered, a, b)))) for a, b in spans]) + bias
            clean = -np.logaddexp(0, z).sum()  # log of the chance that no sentence is toxic
            chance = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            found = [(*spans[i], float(chance[i])) for i in np.flatnonzero(chance >= OFFENDING)]
            return rounded(-np.expm1(clean)), found

        return score


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, sentence numbers), each distinct word of a sentence giving two slots."""
    slots, numbers = [], []
    lowered = (text or "").lower()
    for number, (a, b) in enumerate(sentences(lowered)):
        for word in set(WORD.findall(lowered, a, b)):
            slots += word_slots(word)
            numbers += (number, number)
    return np.array(slots, np.int32), np.array(numbers, np.int32)


def fit_noisy_or(
    bags: list[tuple[np.ndarray, np.ndarray]], answers: np.ndarray, rounds: int = 30, batch: int = 128, seed: int = 11
) -> ToxicModel:
    """Adagrad on the noisy-or's log loss, toxic documents weighing up to BOOST times as much.

    Buckets met in fewer than LEAST_DOCS documents stay out: they could only learn single documents by heart.
    """
    weights, bias = np.zeros(BUCKETS), -5.0
    if not len(answers) or answers.min() == answers.max():
        return ToxicModel(weights.astype(np.float32), -20.0 if not answers.any() else 0.0)
    docs_with = np.zeros(BUCKETS, np.int64)
    toxic_with = np.zeros(BUCKETS, np.int64)
    for (slots, _), y in zip(bags, answers):
        own = np.unique(slots)
        docs_with[own] += 1
        toxic_with[own] += y
    share = answers.mean()
    lean = np.log((toxic_with + 4 * share) / (docs_with - toxic_with + 4 * (1 - share)) * (1 - share) / share)
    # a start for words that toxic documents hold far more often
    known = docs_with >= LEAST_DOCS
    weights[known] = np.clip(HEAD_START * lean[known], 0, 8) * (lean[known] > 1)
    bags = [(slots[known[slots]], numbers[known[slots]], int(numbers[-1]) + 1 if len(numbers) else 0) for slots, numbers in bags]
    boost = float(np.clip((1 - share) / share, 1.0, BOOST))
    seen, bias_seen = np.full(BUCKETS, 1e-2), 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            counts = [bags[i][2] for i in part]
            offsets = np.concatenate([[0], np.cumsum(counts)])
            if not offsets[-1]:
                continue
            slots = np.concatenate([bags[i][0] for i in part])
            owner = np.concatenate([bags[i][1] + offset for i, offset in zip(part, offsets)])
            doc = np.repeat(np.arange(len(part)), counts)
            z = np.bincount(owner, weights=weights[slots], minlength=offsets[-1]) + bias
            clean = np.bincount(doc, weights=-np.logaddexp(0, z), minlength=len(part))
            odds = np.exp(clean) / np.maximum(-np.expm1(clean), 1e-9)  # of clean against toxic
            y = answers[part]
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            pull = np.where(y == 1, -boost * odds, 1.0)[doc] * p / len(part)
            used, place = np.unique(slots, return_inverse=True)
            slope = np.bincount(place, weights=pull[owner], minlength=len(used)) + DECAY * weights[used]
            seen[used] += slope**2 * len(part)
            weights[used] -= 0.3 * slope * np.sqrt(len(part)) / np.sqrt(seen[used])
            total = pull.sum()
            bias_seen += total**2 * len(part)
            bias -= 0.1 * total * np.sqrt(len(part)) / np.sqrt(bias_seen)
    return ToxicModel(weights.astype(np.float32), float(bias))


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> ToxicModel:
    """Fit on about ``sample_rows`` labelled documents of ``sample_bytes`` of text at most.

    An id with several labels is toxic if one of them says so. Labels without a document, null ids
    and null labels are passed over; without both kinds of labels nothing (or all) is toxic.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    answers = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    # at most twice sample_rows ids
    chosen = F.broadcast(bounded_sample(answers, sample_rows, F.col("id")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(chosen, "id")
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    if size > sample_bytes:
        grain = 1 << 40
        rows = rows.filter(F.pmod(F.xxhash64("id", "text", F.lit("bytes")), F.lit(grain)) < F.lit(int(grain * sample_bytes / size)))

    @pandas_udf("slots binary, numbers binary")
    def packed(texts: pd.Series) -> pd.DataFrame:
        found = [bag(t) for t in texts]
        return pd.DataFrame({"slots": [a.tobytes() for a, _ in found], "numbers": [b.tobytes() for _, b in found]})

    got = rows.select("id", "y", packed("text").alias("bag")).select("id", "y", "bag.*").limit(2 * sample_rows).collect()
    got.sort(key=lambda r: (r.id, bytes(r.slots)))  # the same model whatever the order of arrival
    bags = [(np.frombuffer(r.slots, np.int32), np.frombuffer(r.numbers, np.int32)) for r in got]
    return fit_noisy_or(bags, np.array([r.y for r in got], np.int64))


def toxicity_column(text: Column, model: ToxicModel) -> Column:
    @pandas_udf("score double, n_offending int, spans array<struct<start:int,end:int,chance:double>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        score = model.scorer()
        rows = [score(t) for t in texts]
        spans = [[{"start": a, "end": b, "chance": c} for a, b, c in found] for _, found in rows]
        return pd.DataFrame({"score": [s for s, _ in rows], "n_offending": [len(x) for x in spans], "spans": spans})

    return of(text.cast("string"))


def with_toxicity(docs: DataFrame, model: ToxicModel, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` and a struct ``name``: score, n_offending and spans of offending sentences.

    Spans count characters of the text from 0, the end outside. A null or empty text has no sentence
    and scores 0. Scores depend on the text alone, so repeated rows agree. A column called ``name``
    is replaced.
    """
    return docs.withColumn(name, toxicity_column(F.col(text_col), model))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; documents whose id's crc32 is divisible by 5 are never learned from."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    learned = fold(F.col("doc_id"), 5) != 0
    model = learn_toxicity(docs.filter(learned), labels.filter(learned))
    found = with_toxicity(docs, model)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0),
        "toxicity.score",
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        "toxicity.n_offending",
        "toxicity.spans",
    )
