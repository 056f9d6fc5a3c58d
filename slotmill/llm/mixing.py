"""Mixing sources to target weights by entropy balancing.

Every document gets the rate that is nearest to one, in relative entropy, among
all rates under which each source yields its target of words and no document
more than a few copies. The dual problem is convex and has one unknown for each
source: the rate is the exponential of the unknown times the document's size,
cut at the most copies. Newton's iterations sum gradient and curvature over
all documents at once, with the words of the sources as constraints. Rates then
become whole copies: what one document is rounded by is carried to the next
smaller one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotmill.llm.common import materialise, table

#: weights of the sources in the order of their names, repeated
WEIGHTS = (5, 2, 1)
#: copies of a document at most, and how far a target may go beyond its source
MOST_COPIES = 3
#: different documents that are rounded together
LOT_ROWS = 4096
#: a source is balanced when it is within this share of its target, or within half a word
TOLERANCE = 1e-7
#: rounds after which halving alone has brought the unknown to its last digit
MOST_ROUNDS = 80
#: equal rows that are written out at a time
REPEATS = 1 << 16

WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the place of each row in the order of a column, nulls last, from 0. Sorted by all tasks together."""
    order = F.col(column).asc_nulls_last()
    placed = df.repartitionByRange(order).sortWithinPartitions(order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    placed = materialise(placed, "numbered")
    counts = {row["_part"]: row["count"] for row in placed.groupBy("_part").count().collect()}  # one row a task
    before, first = 0, []
    for part in range(max(counts, default=0) + 1):
        first.append(F.lit(before).cast("long"))
        before += counts.get(part, 0)
    return placed.withColumn(name, F.element_at(F.array(*first), F.col("_part") + 1) + F.col("_at")).drop("_part", "_at")


def with_targets(sources: DataFrame, weights: Sequence[int], most_copies: int) -> DataFrame:
    """``sources`` (s, source_size) with ``target`` and ``full``: what a source yields, and whether that is all it can.

    The words of all sources are shared by weight. A source that would go beyond its most copies stops
    there, and the others share what is left, until none does.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("s") % len(weights)).cast("int") + 1).cast(WIDE)
    most = (F.col("source_size") * most_copies).cast(WIDE)
    rest, open_weight = sources.agg(F.sum("source_size").cast(WIDE), F.sum(weight).cast(WIDE)).first()
    total_weight, total = open_weight or Decimal(0), rest or Decimal(0)
    rest = total
    while True:
        # the share of a weight only grows, so a source that is full stays full
        full = weight * F.lit(rest).cast(WIDE) > most * F.lit(open_weight or 0).cast(WIDE)
        taken, gone = sources.filter(full).agg(F.sum(most).cast(WIDE), F.sum(weight).cast(WIDE)).first()
        left, still = total - (taken or 0), total_weight - (gone or 0)
        if (left, still) == (rest, open_weight):
            break
        rest, open_weight = left, still
    shared = weight.cast("double") * F.lit(float(rest)) / F.lit(float(open_weight or 1))
    return sources.withColumns({"full": full, "target": F.when(full, most.cast("double")).otherwise(shared)})


def rate(most_copies: int) -> Column:
    """Copies of a document wanted by its source's unknown; sizes are measured in means of the source."""
    tilted = F.exp(F.least(F.col("unknown") * F.col("size") / F.col("mean"), F.lit(math.log(most_copies) + 1)))
    return F.when(F.col("full"), F.lit(float(most_copies))).otherwise(F.least(tilted, F.lit(float(most_copies))))


def balanced(sizes: DataFrame, sources: DataFrame, most_copies: int, tolerance: float) -> DataFrame:
    """``sources`` (s, source_size, documents, target, full) with the ``unknown`` that solves the dual.

    ``sizes`` (s, size, documents) counts the documents of each size. The step is Newton's for the
    logarithm of the words taken; where it leaves the bounds of the solution, which every round narrows,
    their middle is taken. Sums are decimals, so they do not depend on the order of the rows.
    """
    ratio = F.try_divide("target", "source_size")
    # a document has a word at least, so these bounds hold the solution
    reach = F.col("mean") * F.log(ratio)
    state = sources.withColumn("mean", F.greatest(F.col("source_size"), F.lit(1)) / F.col("documents")).drop("documents").withColumns(
        {
            "low": F.when(ratio < 1, reach).otherwise(0.0),
            "high": F.when(ratio < 1, 0.0).otherwise(F.col("mean") * math.log(most_copies)),
            "unknown": F.lit(0.0),
            "open": ~F.col("full") & (F.col("source_size") > 0) & (F.col("target") != F.col("source_size")),
        }
    )
    state = materialise(state, "state")
    names = state.columns
    words = F.col("size") * F.col("documents") * rate(most_copies)
    bends = F.when(rate(most_copies) < most_copies, words * F.col("size") / F.col("mean"))
    exact = "decimal(38,9)"
    for _ in range(MOST_ROUNDS):
        if state.filter("open").isEmpty():
            break
        asked = sizes.join(state.filter("open").select("s", "unknown", "mean", "full"), "s")
        sums = asked.groupBy("s").agg(F.sum(words.cast(exact)).cast("double").alias("words"), F.sum(bends.cast(exact)).cast("double").alias("bend"))
        off = F.col("words") - F.col("target")
        low = F.when(off < 0, F.col("unknown")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("unknown")).otherwise(F.col("high"))
        step = F.col("unknown") - F.log(F.col("words") / F.col("target")) * F.try_divide("words", "bend")
        next_ = F.when((step > F.col("new_low")) & (step < F.col("new_high")), step).otherwise((F.col("new_low") + F.col("new_high")) / 2)
        done = (F.abs(off) <= F.greatest(F.lit(0.5), F.col("target") * tolerance)) | ~((F.col("new_low") < next_) & (next_ < F.col("new_high")))
        moved = state.join(sums, "s", "left").withColumns({"new_low": low, "new_high": high}).withColumns(
            {
                "unknown": F.when(F.col("open") & ~done, next_).otherwise(F.col("unknown")),
                "low": F.col("new_low"),
                "high": F.col("new_high"),
                "open": F.col("open") & ~done,
            }
        )
        state = materialise(moved.select(names), "state")
    return state


def carried(sizes: np.ndarray, rates: np.ndarray, repeats: np.ndarray, most_copies: int = MOST_COPIES) -> np.ndarray:
    """Whole copies of documents, each ``repeats`` equal rows, in the order of falling sizes.

    Copies are the wanted ones rounded down or up, whichever brings the words so far nearer to those wanted.
    What is left at the end goes to the largest documents that it fits, as one copy more or less.
    """
    wanted = rates * repeats
    least, most = np.floor(wanted).astype(np.int64).tolist(), np.ceil(wanted).astype(np.int64).tolist()
    out, owed = [], 0.0
    for size, want, low, high in zip(sizes.tolist(), wanted.tolist(), least, most):
        owed += want * size
        copies = min(max(round(owed / size), low), high) if size else low
        owed -= copies * size
        out.append(copies)
    for i, (size, limit) in enumerate(zip(sizes.tolist(), (repeats * most_copies).tolist())):
        step = 1 if owed > 0 else -1
        if size and 2 * abs(owed) > size and 0 <= out[i] + step <= limit:
            out[i] += step
            owed -= step * size
    return np.array(out, np.int64)


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tolerance: float = TOLERANCE,
    lot_rows: int = LOT_ROWS,
) -> DataFrame:
    """(id, size, source_size, target, taken, copies, rate, source) for every row of ``docs``.

    ``size`` counts the words of the text, ``taken`` the words of its ``copies``, which are
    ``most_copies`` at most; ``target`` is what the document's source is to yield. ``weights`` go round
    the sources in the order of their code points, a null source last.

    Equal rows (id, size, source) are told apart only by which of them get one copy more, so reruns agree
    whatever the layout. A null text has no words and a document without words takes none. Null ids are ids
    like others; other columns are not used; an empty table gives an empty result. Words taken differ from
    a target by about the smallest document of a lot, more only where a source has so few documents that
    no copies of theirs come nearer.
    """
    if min(weights) <= 0:
        raise ValueError("weights must be above zero")
    rows = docs.select(
        F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source")
    )
    units = materialise(rows.groupBy("source", "id", "size").agg(F.count("*").alias("repeats")), "units")
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("source_size"), F.sum("repeats").alias("documents"), F.count("*").alias("units")
    )
    sources = numbered(sources, "source", "s")
    goals = materialise(with_targets(sources.select("s", "source_size", "documents"), weights, most_copies), "goals")
    named = sources.select("s", F.col("source").alias("name"), "units")
    keyed = units.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sizes = keyed.filter("size > 0").groupBy("s", "size").agg(F.sum("repeats").alias("documents"))
    state = balanced(materialise(sizes, "sizes"), goals, most_copies, tolerance)

    lots = F.ceil(F.col("units") / lot_rows)
    hashed = F.xxhash64("id", "size")
    wanted = keyed.join(state.select("s", "source_size", "target", "unknown", "mean", "full"), "s").select(
        "s", F.pmod(hashed, lots).alias("lot"), hashed.alias("mark"), "id", "source", "size", "repeats", "source_size", "target", rate(most_copies).alias("rate")
    )

    def whole(lot: pa.Table) -> pa.Table:
        sizes, marks, rates, repeats = (lot.column(name).to_numpy() for name in ("size", "mark", "rate", "repeats"))
        order = np.lexsort((marks, -sizes))
        copies = np.empty(len(sizes), np.int64)
        copies[order] = carried(sizes[order], rates[order], repeats[order], most_copies)
        return lot.append_column("all_copies", pa.array(copies)).drop_columns(["s", "lot", "mark"])

    kinds = dict(wanted.dtypes)
    kept = ["id", "source", "size", "repeats", "source_size", "target", "rate"]
    schema = ", ".join(f"{name} {kinds[name]}" for name in kept) + ", all_copies long"
    planned = wanted.groupBy("s", "lot").applyInArrow(whole, schema)
    return repeated(planned).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.col("copies").cast("int").alias("copies"),
        "rate",
        "source",
    )


def repeated(planned: DataFrame) -> DataFrame:
    """The equal rows behind each row of ``planned`` with ``copies``: an equal part of all, and one more for the first."""
    block = F.explode(F.expr(f"sequence(0L, (repeats - 1) div {REPEATS})"))
    row = F.explode(F.expr(f"sequence(block * {REPEATS}, least(repeats, (block + 1) * {REPEATS}) - 1)"))
    copies = F.expr("all_copies div repeats + if(row < all_copies % repeats, 1, 0)")
    return planned.withColumn("block", block).withColumn("row", row).withColumn("copies", copies)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources weighing 5, 2, 1 in turn, with three copies at most."""
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
