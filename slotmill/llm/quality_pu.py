"""Quality classifier from trusted positives and unlabelled text.

The loss is the non-negative risk of positive-unlabelled learning: with class
prior p, loss l and score g it is

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])

where P are trusted good documents and U is text that nobody looked at. Where
the second term is below zero the model has begun to tell the positives from
their like among the unlabelled, so a step is taken back instead. The prior is
estimated first, from how much less of U than of P scores high.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import bounded_sample, fold, held_out, rounded, sigmoid, table
from slotmill.llm.quality_rules import MEASURES, profile

#: bounds of the rows that the classifier is fitted on
POSITIVE_ROWS = 6_000
UNLABELLED_ROWS = 12_000
#: a score from here on is predicted good
THRESHOLD = 0.3

_AT = {name: i for i, name in enumerate(MEASURES)}
#: characters whose share in a text is a feature
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~\n"


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of characters, words and lines over the whole text; zeros without words."""
    m = profile(text)
    n = {name: float(m[i]) for name, i in _AT.items()}
    words, chars = max(n["n_words"], 1.0), max(n["word_chars"], 1.0)
    shares = [
        n["n_symbols"] / chars,
        n["n_letters"] / chars,
        n["n_upper"] / max(n["n_letters"], 1.0),
        n["n_dup_lines"] / max(n["n_lines"], 1.0),
        n["n_repeat_words"] / words,
        n["n_bare_words"] / words,
        n["n_loud_words"] / words,
        n["n_marked_words"] / words,
        n["n_stutters"] / words,
        n["top_word"] / words if words >= 10 else 0.0,
        n["n_ends"] / words,
    ]
    long_words = min(chars / words, 40.0)
    sizes = [np.log1p(n["n_words"]), long_words, np.log1p(words / max(n["n_lines"], 1.0))]
    marks = [text.count(c) / chars for c in MARKS] if n["n_words"] else [0.0] * len(MARKS)
    return np.array(sizes + shares + np.sqrt(np.clip(shares + marks, 0, None)).tolist(), np.float32)


WIDTH = len(features(None))


@dataclass(frozen=True)
class PuModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(standard(x, self.mean, self.scale) @ self.weights + self.bias)


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def _descend(slope, width: int, rounds: int, rate: float = 0.03) -> np.ndarray:
    """Adam on ``slope(w)``."""
    w, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    for step in range(1, rounds + 1):
        g = slope(w)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(p_scores: np.ndarray, u_scores: np.ndarray, slack: float = 1.0) -> float:
    """Share of good documents among the unlabelled, from scores that part P from U.

    Above any threshold U holds at least prior times what P holds there. The smallest ratio of the two
    shares is taken, with a slack for the chance in small tails.
    """
    cuts = np.unique(np.quantile(p_scores, np.linspace(0, 1, 101)))
    of_p = np.array([(p_scores >= c).mean() for c in cuts])
    of_u = np.array([(u_scores >= c).mean() for c in cuts])
    spread = slack * (np.sqrt(1 / len(p_scores)) + np.sqrt(1 / len(u_scores)))
    with np.errstate(divide="ignore", invalid="ignore"):
        upper = np.where(of_p > 0, (of_u + spread) / of_p, np.inf)
    best = int(np.argmin(upper))
    return float(np.clip(of_u[best] / of_p[best], 0.02, 0.98))


def fit_pu(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, rounds: int = 400) -> PuModel:
    """Minimise the non-negative risk; without rows of either kind every score is one half."""
    if not len(positives) or not len(unlabelled):
        return PuModel(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0, 0.5 if prior is None else prior)
    width = positives.shape[1]
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    ones = lambda x: np.concatenate([standard(x, mean, scale), np.ones((len(x), 1))], axis=1)
    p, u = ones(positives.astype(np.float64)), ones(unlabelled.astype(np.float64))
    shrink = np.r_[np.full(width, 1e-3), 0.0]
    if prior is None:
        # half of each kind parts P from U, the other half is counted
        pa, ua = p[::2], u[::2]
        pb, ub = (p[1::2], u[1::2]) if len(p) > 1 and len(u) > 1 else (p, u)
        apart = _descend(lambda w: pa.T @ (sigmoid(pa @ w) - 1) / len(pa) + ua.T @ sigmoid(ua @ w) / len(ua) + shrink * w, width + 1, rounds)
        prior = estimate_prior(pb @ apart, ub @ apart)

    def slope(w):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        # l(g) = log(1 + exp(-g)), so l(-g) = g + l(g)
        negative = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        of_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:
            return -of_negative
        return prior * (p.T @ (sp - 1)) / len(p) + of_negative + shrink * w

    w = _descend(slope, width + 1, rounds)
    return PuModel(mean, scale, w[:-1], float(w[-1]), prior)


def _vectors(docs: DataFrame, text_col: str, limit: int) -> np.ndarray:
    @pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    rows = sorted(bytes(r[0]) for r in docs.select(vector(F.col(text_col).cast("string"))).limit(limit).collect())
    return np.stack([np.frombuffer(r, np.float32) for r in rows]) if rows else np.zeros((0, WIDTH), np.float32)


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> PuModel:
    """Fit on about ``positive_rows`` documents labelled 1 and ``unlabelled_rows`` of all documents.

    An id labelled both 0 and 1 is not trusted. Labels without a document, null ids and null labels
    are passed over.
    """
    trusted = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
    chosen = bounded_sample(trusted.filter("low = 1 AND high = 1").select("id"), positive_rows, F.col("id"))
    # at most twice positive_rows ids
    positives = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"], "left_semi")
    unlabelled = bounded_sample(docs, unlabelled_rows, F.col(id_col), F.col(text_col))
    return fit_pu(_vectors(positives, text_col, 4 * positive_rows), _vectors(unlabelled, text_col, 2 * unlabelled_rows))


def quality_column(text: Column, model: PuModel) -> Column:
    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        found = model.score(np.stack([features(t) for t in texts]))
        return pd.Series([rounded(s) for s in found], dtype="float64")

    return of(text.cast("string"))


def with_quality(docs: DataFrame, model: PuModel, text_col: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the columns ``score`` and ``predicted``, which replace any of those names.

    The score depends on the text alone: a null text scores like an empty one, repeated rows alike.
    """
    scored = docs.withColumn(score, quality_column(F.col(text_col), model))
    return scored.withColumn(predicted, (F.col(score) >= THRESHOLD).cast("int"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; documents whose id's crc32 is divisible by 5 are never learned from."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    learned = fold(F.col("doc_id"), 5) != 0
    model = learn_quality(docs.filter(learned), labels.filter(learned))
    found = with_quality(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0), "score", "predicted")
