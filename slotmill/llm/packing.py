"""Packing of documents into training sequences by conflict-constrained best fit.

Documents are cut into pieces of at most one sequence. Pieces are dealt into
lots by a hash, and a task packs one lot, largest piece first. Its open bins
are kept in the order of the room they have left, and each carries two bitmaps,
of the sources and of the duplicate clusters that it holds. A piece goes to the
tightest bin that has neither its source nor its cluster: the search starts at
the first bin with enough room and goes on to the next until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import materialise, table
from slotmill.llm.simhash import fingerprint_column, labelled

#: words of a training sequence
CAPACITY = 2048
#: pieces that one task packs at a time
LOT_PIECES = 8192
#: words of a shingle of the fingerprints that near copies are found by
NEAR_WORDS = 4
#: most frequent sources of a lot whose bins are kept in lists of their own
APART = 5


def word_count(text: Column) -> Column:
    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([len(t.encode("utf-8", "replace").split()) if t else 0 for t in texts], dtype="int64")

    return of(text.cast("string"))


def _numbers(values: list, least: int = 1) -> dict:
    """A bit for each value that comes ``least`` times or more, the most frequent first; None has no bit."""
    counts = Counter(v for v in values if v is not None)
    return {v: 1 << i for i, (v, n) in enumerate(counts.most_common()) if n >= least}


class Bins:
    """Open bins ordered by room, in one list for each set of the most frequent sources that they hold."""

    def __init__(self, capacity: int, apart: int = APART):
        self.capacity, self.mask = capacity, (1 << apart) - 1
        self.ordered: dict[int, list[tuple[int, int]]] = {}
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[int] = []

    def tightest(self, size: int, source: int, cluster: int) -> int | None:
        """The compatible bin with the least room that is enough; of equal ones the oldest."""
        best = None
        for kind, bins in self.ordered.items():
            if kind & source:
                continue
            for at in range(bisect_left(bins, (size, -1)), len(bins)):
                if best is not None and bins[at] >= best:
                    break
                number = bins[at][1]
                if not (self.sources[number] & source or self.clusters[number] & cluster):
                    best = bins[at]
                    break
        return None if best is None else best[1]

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int, int]:
        """(bin, position, offset) of the piece."""
        number = self.tightest(size, source, cluster) if size < self.capacity else None
        if number is None:
            number = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
            self.held.append(0)
        else:
            own = self.ordered[self.sources[number] & self.mask]
            del own[bisect_left(own, (self.room[number], number))]
        offset, position = self.capacity - self.room[number], self.held[number]
        self.room[number] -= size
        self.held[number] += 1
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if self.room[number]:
            insort(self.ordered.setdefault(self.sources[number] & self.mask, []), (self.room[number], number))
        return number, position, offset


def pack_lot(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int]]:
    """(bin, position, offset) of each piece; sizes are 1 to ``capacity``."""
    source_bit, cluster_bit = _numbers(sources), _numbers(clusters, least=2)
    bins, out = Bins(capacity), [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        out[i] = bins.put(sizes[i], source_bit.get(sources[i], 0), cluster_bit.get(clusters[i], 0))
    return out


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = "source",
    cluster_col: str | None = None,
    lot_pieces: int = LOT_PIECES,
    near_bits: int | None = None,
) -> DataFrame:
    """(id, piece, start_word, n_words, bin_id, position, offset): where each piece of each document goes.

    A bin holds ``capacity`` words at most, and no two pieces of one source or one duplicate cluster
    (without ``cluster_col``: of equal texts, or with ``near_bits`` of the component of near copies whose
    fingerprints are linked by at most so many bits). A longer document is cut into full pieces, each a bin of
    its own, and a rest. ``offset`` is where the piece starts in the bin. A document without words (null
    and empty texts among them) is one row with piece 0, 0 words and null bin, position and offset. A
    null source or cluster conflicts with nothing. Null ids and repeated rows are packed like others;
    other columns are not used; an empty table gives an empty result.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        word_count(text).alias("words"),
        (F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")).alias("source"),
        (F.xxhash64(F.col(cluster_col).cast("string")) if cluster_col else F.xxhash64(text.cast("string"))).alias("cluster"),
        (F.col(cluster_col).isNull() if cluster_col else F.lit(False)).alias("alone"),
        F.monotonically_increasing_id().alias("uid"),
        *([fingerprint_column(text, NEAR_WORDS).alias("fp")] if near_bits is not None and not cluster_col else []),
    )
    # written down, so that a lost task deals its rows out again as before
    rows = materialise(rows.withColumn("cluster", F.when(~F.col("alone"), F.col("cluster"))).drop("alone"), "sizes")
    if "fp" in rows.columns:
        rows = materialise(labelled(rows, near_bits).withColumn("cluster", F.col("component")).drop("fp", "component", "component_id"), "clusters")
    cut = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0)).cast("int")))
    pieces = rows.select("id", "uid", "words", "source", "cluster", cut.alias("piece"))
    start = F.col("piece").cast("long") * capacity
    pieces = pieces.withColumns({"start_word": start, "n_words": F.least(F.col("words") - start, F.lit(capacity)).cast("int")})
    count = pieces.count()
    lots = max(1, -(-count // lot_pieces))
    lot = F.pmod(F.xxhash64("uid", "piece"), F.lit(lots)).cast("int")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["uid", "piece"], ignore_index=True)
        none = frame["source"].where(frame["source"].notna(), None)
        clusters = [None if pd.isna(c) else int(c) for c in frame["cluster"]]
        places = pack_lot(frame["n_words"].tolist(), none.tolist(), clusters, capacity)
        out = frame[["id", "piece", "start_word", "n_words"]].copy()
        base = int(frame["lot"].iloc[0]) << 32
        out["bin_id"] = [base + number for number, _, _ in places]
        out["position"] = [position for _, position, _ in places]
        out["offset"] = [offset for _, _, offset in places]
        return out

    id_type = dict(rows.dtypes)["id"]
    schema = f"id {id_type}, piece int, start_word long, n_words int, bin_id long, position int, offset int"
    filled = pieces.filter("n_words > 0").select("id", "uid", "piece", "start_word", "n_words", "source", F.col("cluster").cast("string").alias("cluster"), lot.alias("lot"))
    placed = filled.groupBy("lot").applyInPandas(pack, schema)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("bin_id", "long"), ("position", "int"), ("offset", "int"))]
    empty = pieces.filter("n_words = 0").select("id", "piece", "start_word", "n_words", *none)
    return placed.union(empty).withColumnRenamed("id", id_col)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 words."""
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), 2048, near_bits=4)
