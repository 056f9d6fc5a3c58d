"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before kept, with all their columns,
and looks only at ``doc_id``, ``text``, ``lang`` (to learn languages) and ``source``.
Null ids are rows like others, empty tables go through empty, texts are read whole
however long, and columns may have further names. What a stage does with null and
empty texts, ties and repeated rows is said below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotmill.llm.common import materialise, table
from slotmill.llm.decontaminate import without_leaks
from slotmill.llm.language import in_known_language, learn_languages, training_rows
from slotmill.llm.packing import packed
from slotmill.llm.quality_rules import well_made
from slotmill.llm.simhash import without_near_copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are bad more likely than not go.

    Null and empty texts go. Repeated rows stay or go together; a posterior of just one half stays.
    """
    return well_made(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with two that are about as likely, go.

    Languages are learned from what is left of the rows with a language; without any, all documents go.
    Repeated rows stay or go together.
    """
    return in_known_language(docs, learn_languages(training_rows(docs)))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays.

    Rows with a null id stay only where their component has no other, and of repeated rows one stays. Texts
    without a word have one fingerprint and are near copies of each other.
    """
    return without_near_copies(docs, words=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Null and empty texts hold nothing and stay; repeated rows stay or go together.
    """
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 words.

    A document without words is one row without a place. Repeated rows are packed each, in different
    sequences; of bins that are equally tight the oldest is taken.
    """
    return packed(docs, 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: components and learned models have no SQL; the tests compare with a plain version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again for the next."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = materialise(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
