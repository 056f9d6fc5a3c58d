"""Hard negatives from an index of Hilbert-ordered blocks with zone maps.

Vectors are put in the order of a Hilbert curve over their main axes and cut
into blocks, each one row of a Parquet table with the smallest and largest
value of every dimension. What an anchor scores with any vector of a block lies
between two bounds that interval arithmetic gives from those values. An anchor
looks for the first rows of a score window, so it reads a block only if the
bounds meet the window and reach above the last row that it would already
return. That last row comes from a first round over a few promising blocks.

All scores are integers and exact; the curve and its sample only decide how
many blocks are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import bounded_sample, materialise, table

#: rows of a block of the index
BLOCK_ROWS = 2048
#: anchors that look through the index together, about
PART_ROWS = 128
#: parts that meet the zone maps together
SLICE_PARTS = 8
#: rows of the neighbouring blocks that one task holds at a time
SHELF_ROWS = 16 * BLOCK_ROWS
#: zone maps that one task holds at a time
ZONES = 1024
#: rows that the axes of the curve are fitted on; they do not change a result
SAMPLE_ROWS = 5_000
#: axes of the curve and bits of each
AXES, BITS = 8, 7
#: ranges of the curve that parts are made within
MOST_RANGES = 1000
#: blocks of an anchor's first round
SEED_BLOCKS = 2
#: integers up to here are exact as doubles, and so are sums that stay below
EXACT = 1 << 53

PACKED = {"dim": pa.int32(), "n": pa.int32(), "least_id": pa.int64(), "low": pa.binary(), "high": pa.binary()}
PACKED |= {"ids": pa.binary(), "labels": pa.binary(), "vectors": pa.binary()}
PACKED_SCHEMA = "dim int, n int, least_id long, low binary, high binary, ids binary, labels binary, vectors binary"
FOUND_SCHEMA = "part long, at int, w int, id long, score long"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whose values are below 2 ** bits (Skilling 2004)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, rest = 1 << level, (1 << level) - 1
        for axis in range(axes):
            far = (x[axis] & bit) != 0
            swap = np.where(far, 0, (x[0] ^ x[axis]) & rest)
            x[0] ^= np.where(far, rest, swap)
            x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as integers, held as doubles."""
    return np.floor(256.0 * vectors.astype(np.float64))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``; Python integers where doubles would round."""
    most = [float(np.abs(m).max(initial=0)) for m in (a, b)]
    if most[0] * most[1] * a.shape[1] < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    wide = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    out = wide[0] @ wide[1].T if a.shape[1] else np.zeros((len(a), len(b)))
    return out.astype(object)


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each vector can have with anything between ``low`` and ``high``."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def _packed(values: np.ndarray) -> bytes:
    """A matrix of integers in the narrowest type that holds it, after one letter that names the type."""
    most = np.abs(values).max(initial=0)
    kind = "h" if most < 1 << 15 else "i" if most < 1 << 31 else "d"
    return kind.encode() + values.astype(kind).tobytes()


def _matrix(raw: bytes, columns: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, chr(raw[0]), offset=1).reshape(rows, columns).astype(np.float64) if columns else np.zeros((rows, 0))


def curve_key(sample: list[np.ndarray], axes: int = AXES, bits: int = BITS) -> Callable[[Column], Column]:
    """Column function for the place on a curve through the main axes of ``sample``."""
    dim = max((len(v) for v in sample), default=0)
    longest = [v for v in sample if len(v) == dim]
    rows = np.array(longest, np.float64).reshape(len(longest), dim)
    rows = rows / (np.abs(rows).max(initial=0) or 1.0)
    centre = rows.mean(axis=0) if len(rows) else np.zeros(dim)
    basis = np.linalg.svd(rows - centre, full_matrices=False)[2][:axes].T if rows.size else np.zeros((dim, 1))
    spread = (rows - centre) @ basis
    least, most = (spread.min(axis=0), spread.max(axis=0)) if len(rows) else (np.zeros(basis.shape[1]), np.ones(basis.shape[1]))
    width = np.where(most > least, most - least, 1.0)

    @pandas_udf("long")
    def of(vectors: pd.Series) -> pd.Series:
        padded = np.zeros((len(vectors), dim))
        for i, v in enumerate(vectors):
            padded[i, : min(dim, len(v))] = v[:dim]
        with np.errstate(over="ignore", invalid="ignore"):
            at = np.nan_to_num((padded - centre) @ basis - least) / width
        cells = np.clip(at * (1 << bits), 0, (1 << bits) - 1)
        return pd.Series(hilbert(cells, bits) if cells.shape[1] else np.zeros(len(vectors), np.int64))

    return of


def packed(ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> dict:
    """Vectors of one dimension as one row, with the zone map of their components."""
    numbers = whole(np.array(vectors).reshape(len(vectors), -1))
    return {
        "dim": numbers.shape[1],
        "n": len(ids),
        "least_id": min(ids),
        "low": numbers.min(axis=0).tobytes(),
        "high": numbers.max(axis=0).tobytes(),
        "ids": np.array(ids, np.int64).tobytes(),
        "labels": np.array(labels, np.int64).tobytes(),
        "vectors": _packed(numbers),
    }


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, label, vector, key) in curve order, written as one row for each ``size`` vectors of one dimension."""
    schema = pa.schema({"block": pa.int64()} | PACKED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int, int, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": base + number} | packed(*map(list, zip(*held)))], schema=schema)

        for batch in batches:
            column = batch.column("vector")
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            for i, (row_id, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())):
                vector = flat[ends[i] : ends[i + 1]].copy()
                if held and (len(held) == size or len(held[0][2]) != len(vector)):
                    yield block()
                    held, number = [], number + 1
                held.append((row_id, label, vector))
        if held:
            yield block()

    order = ("dim", "key", "id")
    ordered = rows.withColumn("dim", F.size("vector")).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ordered.select("id", "label", "vector").mapInArrow(pack, f"block long, {PACKED_SCHEMA}"), "blocks")


def parts_of(anchors: DataFrame, splits: list[int], size: int) -> DataFrame:
    """``anchors`` (id, label, vector, key) as one row for each part of about ``size`` that lie near each other.

    The curve is cut at ``splits``; a range with many anchors, if only of one vector, is dealt into as many
    parts as it needs.
    """
    below = F.filter(F.array(*[F.lit(s) for s in splits]), lambda s: s <= F.col("key")) if splits else F.array()
    ranged = anchors.withColumn("range", F.size(below))
    counts = {row["range"]: row["count"] for row in ranged.groupBy("range").count().collect()}  # one row for each split
    pieces, offsets, total = [], [], 0
    for i in range(len(splits) + 1):
        pieces.append(max(1, -(-counts.get(i, 0) // size)))
        offsets.append(total)
        total += pieces[-1]
    piece = F.pmod(F.xxhash64("uid"), F.element_at(F.array(*[F.lit(n) for n in pieces]), F.col("range") + 1))
    first = F.element_at(F.array(*[F.lit(n).cast("long") for n in offsets]), F.col("range") + 1)
    dealt = ranged.withColumns({"part": first + piece, "dim": F.size("vector")}).select("part", "dim", "id", "label", "vector")

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        row = packed(frame["id"].tolist(), frame["label"].tolist(), frame["vector"].tolist())
        # parts of several dimensions are told apart by their numbers
        return pd.DataFrame([{"part": int(key[0]) + total * int(key[1])} | row])

    return materialise(dealt.groupBy("part", "dim").applyInPandas(pack, f"part long, {PACKED_SCHEMA}"), "anchors")


class Anchors:
    """The anchors of one part with their windows, unpacked in a task."""

    def __init__(self, row):
        self.dim = int(row.dim)
        self.vectors = _matrix(row.vectors, self.dim, int(row.n))
        self.ids, self.labels = np.frombuffer(row.ids, np.int64), np.frombuffer(row.labels, np.int64)
        fields = zip(*[(w["at"], w["w"], w["least"], w["most"], w["last"], w["last_id"]) for w in row.windows])
        self.at, self.w, self.least, self.most, self.last, self.last_id = (np.array(f, np.int64) for f in fields)

    def wants(self, low: np.ndarray, high: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Windows by blocks: the block may hold a row of the window that comes before the last known one, or is it."""
        lower, upper = (side[self.at] for side in bounds(self.vectors, low, high))
        last = self.last[:, None]
        ahead = (upper > last) | ((upper == last) & (least_id <= self.last_id[:, None]))
        return (ahead & (upper >= self.least[:, None]) & (lower <= self.most[:, None])).astype(bool)

    def promising(self, low: np.ndarray, high: np.ndarray, count: int) -> np.ndarray:
        """Windows by blocks: the ``count`` blocks whose bounds reach highest into the window."""
        upper = bounds(self.vectors, low, high)[1][self.at].astype(np.float64)
        best = np.argsort(-np.minimum(upper, self.most[:, None]), axis=1, kind="stable")[:, :count]
        out = np.zeros(upper.shape, bool)
        np.put_along_axis(out, best, True, axis=1)
        return out

    def best_of(self, block, k: int, same: bool) -> pd.DataFrame:
        """The first ``k`` rows of each window in one block, as far as they may matter."""
        low, high = (np.frombuffer(raw, np.float64).reshape(1, -1) for raw in (block.low, block.high))
        open_ = np.flatnonzero(self.wants(low, high, np.array([block.least_id]))[:, 0])
        ids, labels = np.frombuffer(block.ids, np.int64), np.frombuffer(block.labels, np.int64)
        anchors, line = np.unique(self.at[open_], return_inverse=True)
        scores = product(self.vectors[anchors], _matrix(block.vectors, int(block.dim), int(block.n)))
        alike = labels == self.labels[anchors][:, None]
        fits = (alike if same else ~alike) & (ids != self.ids[anchors][:, None])
        fits &= ((scores <= MOST) & (scores > LEAST)).astype(bool)
        floor = np.maximum(self.least, self.last)[open_]
        inside = (scores[line] >= floor[:, None]) & (scores[line] <= self.most[open_][:, None])
        window, column = np.nonzero(fits[line] & inside.astype(bool))
        chosen = open_[window]
        found = {"at": self.at[chosen], "w": self.w[chosen], "id": ids[column], "score": scores[line[window], column].astype(np.int64)}
        return _first(pd.DataFrame(found), k)


def _first(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = rows.iloc[np.lexsort((rows["id"], -rows["score"], rows["w"], rows["at"]))]
    return ordered.groupby(["at", "w"]).head(k)


class Index:
    """Blocks, their zone maps, and the search for the first rows of score windows."""

    def __init__(self, rows: DataFrame, block_rows: int = BLOCK_ROWS, shelf_rows: int = SHELF_ROWS, zones: int = ZONES):
        self.blocks = blocks(rows, block_rows)
        file, number = F.shiftright("block", 32), F.col("block").bitwiseAND((1 << 32) - 1)
        sizes = dict(self.blocks.groupBy(file).agg(F.sum("n")).collect())  # one row for each task that wrote
        before, starts = 0, []
        for at in range(max(sizes, default=0) + 1):
            starts.append(F.lit(before))
            before += sizes.get(at, 0)
        chunks = max(1, -(-self.blocks.count() // zones))
        chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int")
        self.zones = self.blocks.select("block", "dim", "least_id", "low", "high", chunk.alias("chunk"))
        self.chunks = F.sequence(F.lit(0), F.lit(chunks - 1))
        # neighbours on the curve lie on one shelf, also where files are small
        start = F.element_at(F.array(*starts), (file + 1).cast("int"))
        self.shelf = F.floor((start + number * block_rows) / shelf_rows)

    def _round(self, parts: DataFrame, windows: DataFrame, k: int, same: bool, seed: int | None) -> DataFrame:
        """First ``k`` rows of each window in the blocks that may matter, or in ``seed`` of them for each window."""
        window = F.struct("at", "w", "least", "most", "last", "last_id")
        asking = parts.join(windows.groupBy("part").agg(F.collect_list(window).alias("windows")), "part")
        slices = max(1, -(-parts.count() // SLICE_PARTS))
        slice_ = F.pmod(F.xxhash64("part"), F.lit(slices)).cast("int")
        left = asking.withColumns({"chunk": F.explode(self.chunks), "slice": slice_})
        right = self.zones.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

        def choose(asked: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
            picked = [pd.DataFrame({"part": [], "block": []}, dtype=np.int64)]
            for row in asked.itertuples():
                anchors, of_dim = Anchors(row), zones[zones["dim"] == row.dim]
                low, high = (np.frombuffer(b"".join(of_dim[side]), np.float64).reshape(len(of_dim), row.dim) for side in ("low", "high"))
                wanted = anchors.wants(low, high, of_dim["least_id"].to_numpy())
                if seed is not None:
                    wanted &= anchors.promising(low, high, seed)
                picked.append(pd.DataFrame({"part": row.part, "block": of_dim["block"][wanted.any(axis=0)]}))
            return pd.concat(picked)

        chosen = left.groupBy("chunk", "slice").cogroup(right.groupBy("chunk", "slice")).applyInPandas(choose, "part long, block long")
        chosen = materialise(chosen.withColumn("shelf", self.shelf), "chosen")
        asked = asking.join(chosen.select("part", F.col("shelf").alias("place")).distinct(), "part")
        read = chosen.join(self.blocks, "block")

        def look(key: tuple, asked: pd.DataFrame, read: pd.DataFrame) -> pd.DataFrame:
            anchors = Anchors(next(asked.itertuples()))
            best = None
            for block in read.itertuples():
                found = anchors.best_of(block, k, same)
                best = found if best is None else _first(pd.concat([best, found]), k)
            return best.assign(part=key[0])[["part", "at", "w", "id", "score"]]

        found = asked.groupBy("part", "place").cogroup(read.groupBy("part", "shelf")).applyInPandas(look, FOUND_SCHEMA)
        order = Window.partitionBy("part", "at", "w").orderBy(F.desc("score"), "id")
        return materialise(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "found")

    def first(self, parts: DataFrame, windows: DataFrame, k: int, same: bool, seed: int = SEED_BLOCKS) -> DataFrame:
        """(part, at, w, id, score, rank): the first ``k`` rows of each window, by score and then by id.

        ``windows`` has (part, at, w, least, most): which anchor of which part, the window's number, and
        the scores it runs over. ``same`` says whether rows of the anchor's label are looked for, or of others.
        """
        nothing = {"last": F.col("least"), "last_id": F.lit(MOST)}
        first = self._round(parts, windows.withColumns(nothing), k, same, seed)
        last = first.filter(F.col("rank") == k).select("part", "at", "w", F.col("score").alias("last"), F.col("id").alias("last_id"))
        known = windows.join(last, ["part", "at", "w"], "left")
        known = known.withColumns({"last": F.coalesce("last", "least"), "last_id": F.coalesce("last_id", F.lit(MOST))})
        return self._round(parts, known, k, same, None)


def usable(vectors: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    part_rows: int = PART_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For every row whose ``id`` meets ``is_anchor`` and each of its ``positives`` best rows of the same
    ``label`` the best ``negatives`` rows of other labels that score between the two percentages of the
    positive. Scores are inner products of the components' 256-folds, rounded down; the higher comes
    first, of equal ones the smaller id. ``sample_rows`` bounds what the curve's axes are fitted on.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part.
    Vectors of different length are not compared, and two whose score does not fit 64 bits are neither
    positive nor negative to each other. Rows with the anchor's own id are not its other rows; an id
    that is repeated is a row each time, as anchor too. A positive below zero has no negatives, since
    its window is empty. Other columns are not used; an empty table gives an empty result.
    """
    rows = usable(vectors, id_col, F.col("label") if label is None else label, vector_col)
    sample = bounded_sample(rows, sample_rows, F.col("id"))
    column = sample.select("vector").toArrow().column("vector")
    key = curve_key([np.asarray(v.values, np.float64) for chunk in column.chunks for v in chunk])
    keyed = materialise(rows.withColumns({"key": key(F.col("vector")), "uid": F.monotonically_increasing_id()}), "keyed")
    anchors = keyed.filter(is_anchor)
    count = anchors.count()
    cuts = min(MOST_RANGES, -(-count // part_rows)) - 1
    splits = anchors.approxQuantile("key", [(i + 1) / (cuts + 1) for i in range(cuts)], 0.001) if cuts > 0 else []
    parts = parts_of(anchors, sorted({int(s) for s in splits}), part_rows)
    index = Index(keyed.drop("uid"), block_rows)

    whole_range = parts.select("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"))
    ends = {"w": F.lit(0), "least": F.lit(LEAST + 1), "most": F.lit(MOST)}
    near = index.first(parts, whole_range.withColumns(ends), positives, True).drop("w")
    score = F.col("score").cast("decimal(38,0)")
    windows = near.filter("score >= 0").select(
        "part",
        "at",
        F.col("rank").alias("w"),
        ((score * least_percent + 99) / 100).alias("least"),
        (score * most_percent / 100).alias("most"),
    )
    windows = windows.withColumns({side: F.floor(side).cast("long") for side in ("least", "most")}).filter("least <= most")
    far = index.first(parts, windows, negatives, False)
    named = near.select("part", "at", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchor_ids(parts).join(named, ["part", "at"])
    return far.join(names, ["part", "at", "w"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def anchor_ids(parts: DataFrame) -> DataFrame:
    """(part, at, anchor_id)"""

    @pandas_udf("array<long>")
    def listed(ids: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(raw, np.int64) for raw in ids])

    return parts.select("part", F.posexplode(listed("ids")).alias("at", "anchor_id"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the vectors whose id is divisible by 50; every seventh label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), F.col("id") % 50 == 0, moved)


#: the same by comparing every anchor with every row
ORACLE = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
    CAST(list_sum([a.q[i] * o.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM usable a JOIN usable o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
