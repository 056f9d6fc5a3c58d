"""Quality by weak supervision: rules vote or abstain, EM learns how far each can be trusted.

Every rule looks at one measure of the whole text and votes good, bad or not at
all. The votes of a document are one pattern; how often each pattern occurs in
the whole table is all that expectation-maximisation needs, so the model is
fitted on a table of patterns whose size does not depend on the documents. The
posterior of a document is then a sum of learned log odds, one for each rule.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import fresh_name, materialise, table

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_MARK = re.compile(rb"[#*$%&|<>]")
_ASCII = re.compile(r"[\x00-\x7f]+")
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
_NOT_CAPITALS = bytes(c for c in range(256) if c not in _CAPITALS)
_NOT_LETTERS = bytes(c for c in range(256) if c not in _LETTERS)
#: ASCII without letters and digits: a word of these alone is bare
_BARE = bytes(c for c in range(128) if c not in _LETTERS and not 48 <= c <= 57)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

PROFILE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_letters long, n_upper long, n_bare_words long, n_loud_words long, "
    "n_marked_words long, n_stutters long, top_word long, n_ends long"
)
MEASURES = [part.split()[0] for part in PROFILE.split(", ")]
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = 1
    return sum(covered)


def profile(text: str | None) -> tuple[int, ...]:
    """The measures of PROFILE; all 0 for a null text and one without words."""
    raw = text.encode("utf-8", "replace") if text else b""
    words = raw.split()  # at \x20 and \x09-\x0D only
    if not words:
        return (0,) * len(MEASURES)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    beyond = "" if text.isascii() else _ASCII.sub("", text)
    counts = Counter(words)
    n_symbols = sum(map(text.count, SYMBOLS))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        n_symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw.translate(None, _NOT_LETTERS)) + sum(map(str.isalpha, beyond)),
        len(raw.translate(None, _NOT_CAPITALS)) + sum(map(str.isupper, beyond)),
        sum(n for word, n in counts.items() if not word.translate(None, _BARE)),
        sum(n for word, n in counts.items() if word[-1] == 33),
        sum(n for word, n in counts.items() if _MARK.search(word)) if n_symbols else 0,
        sum(map(eq, words, words[1:])),
        max(counts.values()),
        sum(map(text.count, ".!?:;")),
    )


def profile_column(text: Column) -> Column:
    @pandas_udf(PROFILE)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profile(t) for t in texts], columns=MEASURES)

    return of(text.cast("string"))


_MEASURE = re.compile(rf"\b({'|'.join(MEASURES)})\b")


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) where ``bad`` holds, good (1) where ``good`` does, else abstains (0). SQL over PROFILE."""

    name: str
    bad: str
    good: str = "false"

    def vote(self, struct: str) -> Column:
        inside = lambda test: F.expr(_MEASURE.sub(rf"`{struct}`.\g<0>", test))
        return F.when(inside(self.bad), -1).when(inside(self.good), 1).otherwise(0)


RULES = (
    Rule("length", "n_words < 20", "n_words >= 80"),
    Rule("symbols", "n_symbols > 0.05 * word_chars", "n_symbols < 0.01 * word_chars"),
    Rule("repeated_lines", "n_dup_lines > 0.5 * n_lines", "n_dup_lines <= 0.3 * n_lines"),
    Rule("repeated_words", "n_repeat_words > 0.6 * n_words", "n_repeat_words < 0.3 * n_words"),
    Rule("word_length", "word_chars > 14 * n_words OR word_chars < 2 * n_words", "word_chars BETWEEN 3 * n_words AND 11 * n_words"),
    Rule("capitals", "n_upper > 0.4 * n_letters", "n_upper < 0.2 * n_letters"),
    Rule("loud_words", "n_loud_words > 0.15 * n_words", "n_loud_words < 0.05 * n_words"),
    Rule("bare_words", "n_bare_words > 0.2 * n_words", "n_bare_words < 0.05 * n_words"),
    Rule("stutter", "n_stutters > 0.2 * n_words", "n_stutters < 0.05 * n_words"),
    Rule("top_word", "top_word > 0.3 * n_words AND n_words >= 10", "top_word < 0.2 * n_words"),
    Rule("letters", "n_letters < 0.75 * word_chars", "n_letters > 0.85 * word_chars"),
    Rule("marked_words", "n_marked_words > 0.3 * n_words", "n_marked_words < 0.1 * n_words"),
    Rule("sentence_ends", "n_ends = 0 AND n_words >= 40", "n_ends * 40 >= n_words AND n_ends * 2 <= n_words"),
)


@dataclass(frozen=True)
class VoteModel:
    """``odds[j][v]``: what vote v of rule j adds to the log odds of good; ``bias``: the prior's log odds."""

    bias: float
    odds: tuple[dict[int, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        total = F.lit(self.bias)
        for vote, odds in zip(votes, self.odds):
            total = total + F.when(vote == -1, odds[-1]).when(vote == 1, odds[1]).otherwise(odds[0])
        return 1 / (1 + F.exp(-total))


def fit_votes(patterns: dict[tuple[int, ...], int], rules: int, rounds: int = 100, trust: float = 0.02) -> VoteModel:
    """EM over vote patterns and their counts, for two classes.

    Each rule has a chance of each vote in each class. The start is the balance of the votes, and
    pseudo counts, ``trust`` of all rows, say that a vote is likelier in its own class, so that the
    classes keep their names. Without rows every posterior is one half.
    """
    total = sum(patterns.values())
    if not total:
        return VoteModel(0.0, tuple({-1: 0.0, 0: 0.0, 1: 0.0} for _ in range(rules)))
    # a bad vote is rare and says more than a good one
    good = {p: 1 / (1 + math.exp(-(0.5 * p.count(1) - 2.5 * p.count(-1)))) for p in patterns}
    leaning = {1: {1: 0.5, 0: 0.45, -1: 0.05}, 0: {1: 0.25, 0: 0.45, -1: 0.3}}
    for _ in range(rounds):
        mass = {1: trust * total, 0: trust * total}
        votes = [{y: {v: trust * total * leaning[y][v] for v in (-1, 0, 1)} for y in (0, 1)} for _ in range(rules)]
        for pattern, n in patterns.items():
            for y, share in ((1, good[pattern] * n), (0, (1 - good[pattern]) * n)):
                mass[y] += share
                for j, v in enumerate(pattern):
                    votes[j][y][v] += share
        chance = [{y: {v: votes[j][y][v] / mass[y] for v in (-1, 0, 1)} for y in (0, 1)} for j in range(rules)]
        odds = tuple({v: math.log(c[1][v] / c[0][v]) for v in (-1, 0, 1)} for c in chance)
        bias = math.log(mass[1] / mass[0])
        moved = 0.0
        for pattern in patterns:
            z = bias + sum(o[v] for o, v in zip(odds, pattern))
            now = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
            moved = max(moved, abs(now - good[pattern]))
            good[pattern] = now
        if moved < 1e-6:
            break
    return VoteModel(bias, odds)


def judged(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
    name: str = "quality",
) -> DataFrame:
    """The columns ``keep`` (default: all) and a struct ``name`` with the measures and the verdict.

    Fields: those of PROFILE, base_failed, posterior (of good) and kept. A null text has no words and
    fails the base rules, like an empty one; repeated rows get equal verdicts, each of them counted.
    ``name`` must not be a column of ``docs``.
    """
    profiled = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)], profile_column(F.col(text_col)).alias(name))
    profiled = materialise(profiled, "profiles")
    cast = [rule.vote(name) for rule in rules]
    counted = profiled.groupBy(*[vote.alias(f"v{j}") for j, vote in enumerate(cast)]).count()
    # three votes a rule: the patterns are bounded by the rules, not by the rows
    patterns = {tuple(row)[:-1]: row["count"] for row in counted.collect()}
    model = fit_votes(patterns, len(rules))
    failed = (F.col(f"{name}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{name}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{name}.n_words")
    )
    posterior = model.posterior(cast)
    return profiled.withColumn(
        name,
        F.struct(f"{name}.*", failed.alias("base_failed"), posterior.alias("posterior"), (~failed & (posterior >= threshold)).alias("kept")),
    )


def well_made(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are.

    Null and empty texts and all of fewer than fifty words fail the base rules and go. Repeated rows stay or go
    together, and each counts where accuracies are estimated; at a posterior of just the threshold a row stays.
    Ids and other columns are not looked at and may have any names; an empty table stays empty.
    """
    name = fresh_name(docs, "_quality")
    return judged(docs, text_col, name=name, **options).filter(F.col(f"{name}.kept")).select(docs.columns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every document."""
    found = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", *[f"quality.{c}" for c in BASE], "quality.base_failed", "quality.kept", "quality.posterior")
