"""Sharding by histogram sort.

Rows are ordered by a key that spreads texts evenly and keeps equal texts
together. Boundaries between shards are found by probing: each round counts the
exact bytes and rows below a set of candidate keys over all partitions, and
every boundary that is not near enough to its target gets new candidates
between the two that enclose it. When all are near enough, rows go to their
place in one exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import materialise, table

LAW = "bytes"
SHARDS = 16
#: share of a shard that a boundary may lie off its target; one row is always allowed
TOLERANCE = 0.001
#: candidates for each open boundary and round
PROBES = 16
#: bytes that one task of the exchange gets; shards are cut into parts of about this size
PART_BYTES = 256_000_000

#: order of the rows: (hash of the text, hash of the id, number of the row); no two rows share all three
KEY = ("k1", "k2", "k3")
LOW, SPAN = -(1 << 63), 1 << 64


def joined(key: tuple[int, int, int]) -> int:
    """The three parts as one number in the same order."""
    a, b, c = (part - LOW for part in key)
    return (a << 128) | (b << 64) | c


def parted(number: int) -> tuple[int, int, int]:
    return tuple(((number >> shift) & (SPAN - 1)) + LOW for shift in (128, 64, 0))


def interval_column(bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at or below the row's key."""
    parts = np.array([parted(b) for b in bounds], np.int64).reshape(-1, 3)
    first = parts[:, 0]

    @pandas_udf("int")
    def of(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        a = k1.to_numpy()
        low, high = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
        out = high.astype(np.int32)
        tied = np.flatnonzero(low < high)
        if len(tied):
            b, c = k2.to_numpy(), k3.to_numpy()
            for at in range(int((high - low).max())):
                # bounds that share the row's first part are told apart one after the other
                open_ = tied[low[tied] + at < high[tied]]
                bound = parts[low[open_] + at]
                above = (bound[:, 1] > b[open_]) | ((bound[:, 1] == b[open_]) & (bound[:, 2] > c[open_]))
                out[open_] -= above
        return pd.Series(out)

    return of(*[F.col(k) for k in KEY])


@dataclass
class Cell:
    """Rows between two neighbouring candidates: what lies before it, what it holds, its end keys."""

    bytes_before: int
    rows_before: int
    bytes: int
    rows: int
    low: int
    high: int


def histogram(keyed: DataFrame, bounds: list[int]) -> list[Cell]:
    """One cell for each interval that has rows; their number is bounded by the candidates."""
    key = F.struct(*KEY)
    counted = (
        keyed.withColumn("cell", interval_column(bounds))
        .groupBy("cell")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()
    )
    cells, at_bytes, at_rows = [], 0, 0
    for row in sorted(counted, key=lambda r: r.cell):
        cells.append(Cell(at_bytes, at_rows, row.bytes, row.rows, joined(tuple(row.low)), joined(tuple(row.high))))
        at_bytes += row.bytes
        at_rows += row.rows
    return cells


@dataclass(frozen=True)
class Splitters:
    bounds: list[int]  # first key of every part but the first
    rows_before: list[int]  # exact rows below each of them
    bytes_before: list[int]


def find_splitters(keyed: DataFrame, parts: int, tolerance: float, probes: int = PROBES) -> Splitters:
    """Keys that cut the rows of ``keyed`` (k1, k2, k3, size) into ``parts`` of nearly equal bytes.

    A boundary stops when it is within ``tolerance`` of a part of its target, or when the row that
    the target falls into is found, so the nearer end of that row is the best there is.
    """
    cells = histogram(keyed, [])
    total = cells[0].bytes if cells else 0
    if not cells or parts < 2:
        return Splitters([], [], [])
    targets = [total * i / parts for i in range(1, parts)]
    slack = tolerance * total / parts
    found: dict[int, tuple[int, int, int]] = {}
    # per open boundary the enclosing cell
    open_: dict[int, Cell] = dict.fromkeys(range(len(targets)), cells[0])
    while open_:
        wanted = set()
        inside_of: dict[int, list[int]] = {}
        for i, cell in open_.items():
            inside_of.setdefault(cell.low, []).append(i)
        for inside in inside_of.values():
            cell = open_[inside[0]]
            width = cell.high - cell.low + 1
            steps = probes * len(inside) if len(inside) < 64 else 4 * len(inside)
            wanted |= {cell.low + width * s // steps for s in range(1, steps)} | {cell.low, cell.high, cell.high + 1}
            for i in inside:  # keys are hashes, so a target lies about where its share of the bytes says
                guess = cell.low + int(width * (targets[i] - cell.bytes_before) / max(cell.bytes, 1))
                wanted.add(min(max(guess, cell.low), cell.high))
        bounds = sorted(w for w in wanted if w < 1 << 192)
        cells = histogram(keyed, bounds)
        starts = np.array([c.bytes_before for c in cells], np.float64)
        for i in list(open_):
            at = max(0, int(np.searchsorted(starts, targets[i], "right")) - 1)
            cell = cells[at]
            before, after = targets[i] - cell.bytes_before, cell.bytes_before + cell.bytes - targets[i]
            single = cell.low == cell.high
            if before <= after and (before <= slack or single):
                found[i] = (cell.low, cell.rows_before, cell.bytes_before)
            elif after < before and (after <= slack or single):
                follower = cells[at + 1].low if at + 1 < len(cells) else cell.high + 1
                found[i] = (follower, cell.rows_before + cell.rows, cell.bytes_before + cell.bytes)
            else:
                open_[i] = cell
                continue
            del open_[i]
    order = [found[i] for i in range(len(targets))]
    return Splitters([b for b, _, _ in order], [r for _, r, _ in order], [s for _, _, s in order])


def shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    Law ``bytes``: the shards' sizes differ from each other by no more than ``tolerance`` of a shard
    and one row on either side. A size is the text's UTF-8 bytes and 1; a null text has size 1 and
    crc32 0, like an empty one. Slots number the rows of a shard from 0 in key order. Equal texts are
    neighbours, and a group too large for a shard goes on in the next. Null ids and repeated rows are
    ordinary rows: a row number, written down before the first count, tells them apart. Other columns
    are not used; an empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    keyed = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"),
        F.xxhash64(F.col(id_col)).alias("k2"),
        F.monotonically_increasing_id().alias("k3"),
    )
    keyed = materialise(keyed, "keyed")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (shards * part_bytes)))
    splitters = find_splitters(keyed, shards * per_shard, tolerance)
    place = interval_column(splitters.bounds) if splitters.bounds else F.lit(0)
    starts = np.array([0, *splitters.rows_before], np.int64)
    # first row of a part, counted within its shard
    offsets = (starts - np.repeat(starts[::per_shard], per_shard)[: len(starts)]).tolist() if len(starts) > 1 else [0]
    parts = docs.sparkSession.createDataFrame(
        pd.DataFrame({"part": np.arange(len(offsets), dtype=np.int32), "first": np.array(offsets, np.int64)}), "part int, first long"
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*KEY))
    ranked = keyed.withColumn("part", place.cast("int")).withColumn("rank", rank)
    # one row for each part, so as many as the exchange has tasks
    placed = ranked.join(F.broadcast(parts), "part")
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.floor(F.col("part") / per_shard).cast("int").alias("shard"),
        (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    return shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
