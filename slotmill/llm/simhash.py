"""Near copies by SimHash and deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that
differ in at most five bits have a segment in which they differ in one bit at
most, so with the right bit of that segment left out they agree on the rest.
Every fingerprint is therefore listed once per bit of every segment under
(segment, bit left out, other bits); fingerprints that meet under a key are
compared in full. Equal fingerprints are one node throughout, so copies never
meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import fresh_name, materialise, table
from slotmill.llm.components import connected, spanning_links

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BITS = 64
#: (first bit, width) of the segments
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: fingerprints under one key that a task compares by itself; longer lists are dealt out as pairs of blocks
BLOCK = 200_000
#: lists up to this length are compared by shifting whole columns, longer ones tile by tile
SHORT, TILE = 32, 256

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash as a signed integer; 0 without a word."""
    if not text:
        return 0
    # bytes.split() splits at \x20 and \x09-\x0D only, bytes.lower() changes A-Z only
    parts = text.encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    line, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = np.array([digest(line, HASH_SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        spans = zip(starts[: len(parts) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist())
        hashes = np.fromiter((digest(line[a:b], HASH_SEED) for a, b in spans), np.uint64, len(parts) - words + 1)
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 256:
        set_bits = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        set_bits = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    packed = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprint_column(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return of(text.cast("string"))


def variants(nodes: DataFrame) -> DataFrame:
    """(key, fp), one row for each bit that is left out."""
    keys = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            kept = segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            keys.append(F.shiftleft(kept, 6) + F.lit(first + bit))
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key"))


def long_lists(nodes: DataFrame, block: int) -> DataFrame:
    """(first, value, n): segment values that so many fingerprints hold that a list may pass ``block``.

    A list holds the fingerprints of two segment values, so one of them has half of a long list.
    """
    values = [
        F.struct(F.lit(first).alias("first"), F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for first, width in SEGMENTS
    ]
    held = nodes.select(F.explode(F.array(*values)).alias("s")).select("s.first", "s.value")
    return held.groupBy("first", "value").agg(F.count("*").alias("n")).filter(F.col("n") * 2 > block)


def dealt(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, part, fp): what meets under a key and part is compared.

    ``part`` is 0 unless the list of a key is longer than ``block``. Such a list is cut into blocks
    by a hash, and a fingerprint goes to the pairs of its own block with every block.
    """
    listed = variants(nodes)
    hot = long_lists(nodes, block)
    if hot.isEmpty():
        return listed.select("key", F.lit(0).alias("part"), "fp")
    masked = []
    for first, width in SEGMENTS:
        for bit in range(width):
            other = F.col("value").bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            here = F.col("first") == first
            masked.append(F.when(here, F.shiftleft(other, 6) + F.lit(first + bit)))
    keys = hot.select("n", F.explode(F.array_compact(F.array(*masked))).alias("key"))
    blocks = keys.groupBy("key").agg(F.ceil(F.sum("n") * 2 / block).cast("int").alias("blocks"))
    marked = listed.join(blocks, "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    spread = marked.select("key", "fp", own.alias("own"), others.alias("other"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
    part = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    return spread.select("key", part.cast("int").alias("part"), "fp")


def _links_of_short(run: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links within runs of equal ``run`` numbers, for runs of SHORT rows at most."""
    left, right = [], []
    at = np.arange(len(fp))
    for shift in range(1, SHORT):
        at = at[at + shift < len(fp)]
        at = at[run[at] == run[at + shift]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + shift]) <= max_bits]
        left.append(fp[near])
        right.append(fp[near + shift])
    return left, right


def _links_of_long(fp: np.ndarray, max_bits: int):
    """Spanning links of one list, tile against tile; tiles that are one component already are passed over."""
    label = np.arange(len(fp))
    starts = range(0, len(fp), TILE)
    for i in starts:
        a = slice(i, i + TILE)
        for j in range(i, len(fp), TILE):
            b = slice(j, j + TILE)
            low = min(label[a].min(), label[b].min())
            if max(label[a].max(), label[b].max()) == low:
                continue
            x, y = np.nonzero(np.bitwise_count(fp[a, None] ^ fp[None, b]) <= max_bits)
            x, y = label[x + i], label[y + j]
            apart = x != y
            if apart.any():
                root, child = spanning_links(x[apart], y[apart])
                moved = np.arange(len(fp))
                moved[child] = root
                label = moved[label]
    child = np.flatnonzero(label != np.arange(len(fp)))
    return [fp[label[child]]], [fp[child]]


def link_lists(max_bits: int):
    """Function for mapInArrow over rows (key, part, fp) sorted by key and part: spanning links (u, v)."""

    def links(key: np.ndarray, part: np.ndarray, fp: np.ndarray):
        fresh = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1
        bounds = np.concatenate([[0], fresh, [len(fp)]])
        sizes = np.diff(bounds)
        run = np.repeat(np.arange(len(sizes)), sizes)
        short = sizes[run] <= SHORT
        left, right = _links_of_short(run[short], fp[short], max_bits)
        for i in np.flatnonzero(sizes > SHORT):
            more = _links_of_long(fp[bounds[i] : bounds[i + 1]], max_bits)
            left += more[0]
            right += more[1]
        if not sum(map(len, left)):
            return None
        u, v = spanning_links(np.concatenate(left), np.concatenate(right))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last list of a batch may go on in the next one
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            key, part = rows[0], rows[1]
            ends = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            cut = ends[-1] + 1 if len(ends) else 0
            if not cut and held and (held[-1][0][-1], held[-1][1][-1]) == (key[0], part[0]):
                held.append(rows)
                continue
            held.append([r[:cut] for r in rows])
            out = links(*_joined(held))
            if out is not None:
                yield out
            held = [[r[cut:] for r in rows]]
        if held:
            out = links(*_joined(held))
            if out is not None:
                yield out

    def _joined(pieces):
        key, part, fp = (np.concatenate([p[i] for p in pieces]) for i in range(3))
        return key, part, fp.view(np.uint64)

    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that connect the fingerprints of ``nodes`` just as all pairs within ``max_bits`` would."""
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError(f"at most {2 * len(SEGMENTS) - 1} bits with {len(SEGMENTS)} segments")
    lists = dealt(nodes, block).repartition("key", "part").sortWithinPartitions("key", "part")
    return lists.mapInArrow(link_lists(max_bits), "u long, v long")


def labelled(rows: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``rows`` (id, fp and others) with ``component``, a fingerprint of each component, and ``component_id``."""
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    roots = materialise(connected(near_links(nodes, max_bits, block)), "roots")
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    lowest = grouped.groupBy("root").agg(F.min("low").alias("lowest"))
    linked = roots.join(lowest, "root").select(F.col("node").alias("fp"), "root", "lowest")
    known = nodes.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("component"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id"),
    )
    # written down, so that only a shuffle stands below either side of the join and a hot fingerprint can be split
    return rows.join(materialise(known, "known"), "fp")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """(id, fingerprint, component_id, component): one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` bits, itself
    included; ``component`` names the component by one of its fingerprints and is never null.

    A null or empty text, and one of white space, has fingerprint 0 and is linked like any other.
    Rows with a null id stay; they count for no ``component_id``, which is null where a component
    has no other rows. Repeated rows are returned as often as they come. Other columns of ``docs``
    are not used. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), words).alias("fp"))
    found = labelled(materialise(rows, "fingerprints"), max_bits, block)
    return found.select(
        F.col("id").alias(id_col), hex_of("fp").alias("fingerprint"), "component_id", hex_of("component").alias("component")
    )


def hex_of(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def without_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest id.

    Rows with a null id stay only where their component has no other; of repeated rows one stays.
    """
    text, mark = F.col(text_col), F.xxhash64(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), fingerprint_column(text, words).alias("fp"), mark.alias("mark"))
    found = labelled(materialise(rows, "fingerprints"), max_bits, block)
    best = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")).alias("best"))
    own_id, own_mark = fresh_name(docs, "_id"), fresh_name(docs, "_mark")
    winners = best.select(
        F.coalesce(F.col("best.id").cast("string"), F.lit("")).alias(own_id), F.col("best.mark").alias(own_mark)
    )
    marked = docs.withColumns({own_id: F.coalesce(F.col(id_col).cast("string"), F.lit("")), own_mark: mark})
    kept = marked.join(winners, [own_id, own_mark], "left_semi")
    return kept.dropDuplicates([own_id, own_mark]).select(docs.columns)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy components of all documents: four-word shingles, four bits."""
    return near_copies(table(spark, sf_dir, "documents"), words=4, max_bits=4)
