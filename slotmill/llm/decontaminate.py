"""Benchmark decontamination by pigeonhole edit matching.

A test item is looked for by its passages: every run of sixteen or of twenty-four
words, or all of a shorter item. A passage may be met with an edit budget of k, so it is split
into k + 1 pieces, of which k edits leave at least one untouched. No piece is
shorter than sixteen bytes, so whatever passage and piece it is, some stretch of
sixteen bytes of the item stands in the document as it is. Those stretches are
the table that documents are joined with; each hit puts the item beside a place
of the document, where Myers' bit-parallel algorithm computes the smallest edit
distance to the passages around the hit.

Documents are read once, whatever the size of the benchmark: a bit filter of all
stretches tells which places can be hits at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import fresh_name, materialise, table

#: words of a passage; the longer one may differ by more edits
PASSAGE_WORDS = (16, 24)
#: bytes of a piece at least, and of the stretches that are looked up
PIECE_BYTES = 16
#: a passage of so many bytes may also have one word replaced, left out or put in, however long
WORD_EDIT_BYTES = 48
#: a shorter item only matches a document that is the item and nothing else
LEAST_BYTES = 24
#: below this a passage has no budget and must begin and end with a word of the document
LOOSE_BYTES = 2 * PIECE_BYTES
#: bytes that a new word may have, as far as it moves the words behind it
NEW_WORD_BYTES = 40
#: bits of the filter for each stretch of the benchmark, and of the filter at least and at most
BITS_EACH, LEAST_BITS, MOST_BITS = 128, 1 << 20, 1 << 30
#: a stretch sets the bits that these parts of its number name
SHIFTS = (0, 11, 22, 33)
#: bytes of a text whose stretches are computed at a time
SPAN = 1 << 20

#: ASCII signs and white space become spaces; other bytes stay
_SPACED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def normal(text: str | None) -> bytes:
    """Lower case, words parted by single spaces, UTF-8. Distances and starts count its bytes."""
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_SPACED).split())


def passages(item: bytes) -> list[tuple[int, int]]:
    """(start, end) of every run of so many words, or of the whole item where it has fewer."""
    starts, at = [], 0
    for word in item.split(b" "):
        starts.append(at)
        at += len(word) + 1
    ends = [start - 1 for start in starts[1:]] + [len(item)]
    spans = {}
    for words in PASSAGE_WORDS:
        size = min(words, len(starts))
        spans |= dict.fromkeys((starts[i], ends[i + size - 1]) for i in range(len(starts) - size + 1))
    return list(spans)


def edit_budget(length: int) -> int:
    """Byte edits that a passage of ``length`` bytes may differ by: as many as leave pieces of ``PIECE_BYTES``."""
    return max(0, length // PIECE_BYTES - 1)


class Pattern:
    """A sequence ready for Myers' algorithm: the bytes of a passage, or its words."""

    def __init__(self, symbols: Sequence):
        self.symbols, self.length = symbols, len(symbols)
        self.masks: dict = {}
        for i, symbol in enumerate(symbols):
            self.masks[symbol] = self.masks.get(symbol, 0) | 1 << i

    def distance(self, window: Sequence) -> int:
        """Smallest edit distance between the pattern and any stretch of ``window``."""
        full, last = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, score, best, masks = full, 0, self.length, self.length, self.masks
        for symbol in window:
            equal = masks.get(symbol, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & last:
                score += 1
            elif down & last:
                score -= 1
                best = min(best, score)
            up, down = up << 1 & full, down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
        return best


def stretches(line: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(position of the first, numbers) of all stretches of ``PIECE_BYTES`` bytes, span by span."""
    for start in range(0, len(line) - PIECE_BYTES + 1, SPAN):
        one = np.frombuffer(line[start : start + SPAN + PIECE_BYTES - 1], np.uint8).astype(np.uint64)
        two = one[:-1] | one[1:] << np.uint64(8)
        four = two[:-2] | two[2:] << np.uint64(16)
        eight = four[:-4] | four[4:] << np.uint64(32)
        mixed = eight[:-8] * np.uint64(0x9E3779B97F4A7C15) + (eight[8:] ^ eight[8:] >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
        yield start, mixed ^ mixed >> np.uint64(32)


def whole_number(line: bytes) -> int:
    """The number of a line as a whole, for items too short for a stretch of their own."""
    return xxhash.xxh64_intdigest(line, seed=LEAST_BYTES)


def numbered(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, positions) under which an item is looked up."""
    if len(line) < LEAST_BYTES:
        return np.array([whole_number(line)] if line else [], np.uint64), np.zeros(int(bool(line)), np.int32)
    parts = list(stretches(line))
    numbers = np.concatenate([part for _, part in parts])
    return numbers, np.arange(len(numbers), dtype=np.int32)


class Item:
    """A benchmark item and how a document holds it."""

    def __init__(self, text: bytes):
        self.text, self.spans = text, passages(text)

    def best(self, line: bytes, diagonals: Sequence[tuple[int, int, int]]) -> tuple[int, int, int, int] | None:
        """(distance, budget, word edits, start) of the passage met best, if any is.

        ``diagonals`` has (place, first, last): stretches of the item from byte ``first`` to ``last`` stand
        ``place`` bytes further on in the line.
        """
        if len(self.text) < LEAST_BYTES:
            return (0, 0, 0, 0) if line == self.text else None
        near = [
            (place, start, end)
            for place, first, last in diagonals
            for start, end in self.spans
            if start <= last and end >= first + PIECE_BYTES
        ]
        for place, start, end in near:
            at = place + start
            if at >= 0 and line[at : place + end] == self.text[start:end] and self._bounded(line, at, place + end):
                return 0, edit_budget(end - start), 0, at
        met = (self._edited(line, place, start, end) for place, start, end in near)
        return min((m for m in met if m), default=None, key=lambda m: (m[2], m[0], m[3]))

    @staticmethod
    def _bounded(line: bytes, start: int, end: int) -> bool:
        """A short passage stands between words; a longer one may begin and end within them."""
        whole = (start == 0 or line[start - 1] == 32) and (end == len(line) or line[end] == 32)
        return whole or end - start >= LOOSE_BYTES

    def _edited(self, line: bytes, place: int, start: int, end: int) -> tuple[int, int, int, int] | None:
        length = end - start
        budget, at = edit_budget(length), max(0, place + start)
        if not budget:
            return None
        passage, margin = self.text[start:end], budget + NEW_WORD_BYTES
        window = line[max(0, at - margin) : place + end + margin]
        words, around = passage.split(b" "), window.split(b" ")
        known = set(around)
        # an edit damages two words at most, and a word edit one
        if sum(word not in known for word in words) > max(2 * budget, 1):
            return None
        close = line[max(0, at - budget) : place + end + budget]
        distance = Pattern(passage).distance(close)
        if distance <= budget:
            return distance, budget, 0, at
        if length >= WORD_EDIT_BYTES and Pattern(words).distance(around) <= 1:
            return Pattern(passage).distance(window), budget, 1, at
        return None


def _bits(pieces: DataFrame) -> tuple[bytes, int]:
    """The filter of the benchmark's stretches; its size follows their number up to a bound."""
    count = pieces.count()
    bits = min(max(LEAST_BITS, 1 << (BITS_EACH * count).bit_length()), MOST_BITS)
    places = [F.shiftrightunsigned("number", shift).bitwiseAND(bits - 1) + 1 for shift in SHIFTS]
    rows = pieces.select(F.explode(F.array(*places)).alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    packed = bytearray(bits // 8)
    for row in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toLocalIterator():
        at = (row.bucket - 1) * 4096
        packed[at : at + 4096] = row.bits
    return bytes(packed), bits


class Benchmark:
    """The items of a benchmark, the table of their stretches, and the filter of that table."""

    def __init__(self, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
        @pandas_udf("struct<line:binary,numbers:array<long>,positions:array<int>>")
        def prepared(texts: pd.Series) -> pd.DataFrame:
            lines = [normal(t) for t in texts]
            found = [numbered(line) for line in lines]
            return pd.DataFrame(
                {"line": lines, "numbers": [n.view(np.int64) for n, _ in found], "positions": [p for _, p in found]}
            )

        rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), prepared(F.col(text_col).cast("string")).alias("it"))
        rows = rows.filter(F.octet_length("it.line") > 0).withColumn("item", F.monotonically_increasing_id())
        rows = materialise(rows.select("item", "item_id", "it.*"), "items")
        self.items = rows.select("item", "item_id", F.col("line").alias("text"))
        self.pieces = rows.select("item", F.inline(F.arrays_zip(F.col("numbers").alias("number"), F.col("positions").alias("position"))))
        self.packed, self.bits = _bits(self.pieces)

    def scanned(self, docs: DataFrame, text_col: str, name: str) -> DataFrame:
        """``docs`` with a column ``name`` of the normal text and the places that may be hits; the text only if there are any."""
        packed, bits = self.packed, self.bits

        @pandas_udf("struct<line:binary,numbers:array<long>,positions:array<int>>")
        def places(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            filter_, mask = np.frombuffer(packed, np.uint8), np.uint64(bits - 1)

            def known(numbers: np.ndarray) -> np.ndarray:
                hits = np.arange(len(numbers))
                for shift in SHIFTS:  # few are left after the first
                    at = numbers[hits] >> np.uint64(shift) & mask
                    hits = hits[filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 != 0]
                return hits

            def of(text: str | None) -> tuple[bytes | None, np.ndarray, np.ndarray]:
                line = normal(text)
                found = [(start, numbers, known(numbers)) for start, numbers in stretches(line)]
                numbers = [numbers[hits] for _, numbers, hits in found]
                positions = [(start + hits).astype(np.int32) for start, _, hits in found]
                if line and len(line) < LEAST_BYTES:
                    whole = np.array([whole_number(line)], np.uint64)
                    numbers.append(whole[known(whole)])
                    positions.append(np.zeros(len(numbers[-1]), np.int32))
                if not sum(map(len, numbers)):
                    return None, np.zeros(0, np.int64), np.zeros(0, np.int32)
                return line, np.concatenate(numbers).view(np.int64), np.concatenate(positions)

            for texts in batches:
                yield pd.DataFrame([of(t) for t in texts], columns=["line", "numbers", "positions"])

        # so that a filter on the result does not compute it twice
        return docs.withColumn(name, places.asNondeterministic()(F.col(text_col).cast("string")))

    def held(self, suspects: DataFrame) -> DataFrame:
        """(uid, item_id, distance, budget, word_edits, start) from ``suspects`` (uid, line, numbers, positions), a written table.

        Places meet the benchmark's stretches by their number; what lies on one diagonal of a document and
        an item is one row before the texts are fetched.
        """
        places = suspects.select("uid", F.inline(F.arrays_zip(F.col("numbers").alias("number"), F.col("positions").alias("at"))))
        shifted = places.join(self.pieces, "number").groupBy("uid", "item", (F.col("at") - F.col("position")).alias("place"))
        diagonals = shifted.agg(F.min("position").alias("first"), F.max("position").alias("last"))
        pairs = diagonals.groupBy("uid", "item").agg(F.sort_array(F.collect_list(F.struct("place", "first", "last"))).alias("diagonals"))
        beside = pairs.join(suspects.select("uid", "line"), "uid").join(self.items, "item")

        @pandas_udf("struct<distance:int,budget:int,word_edits:int,start:int>")
        def best(lines: pd.Series, texts: pd.Series, diagonals: pd.Series) -> pd.DataFrame:
            known: dict[bytes, Item] = {}
            out = []
            for line, text, listed in zip(lines, texts, diagonals):
                if text not in known:
                    known[text] = Item(text)
                out.append(known[text].best(line, [(d["place"], d["first"], d["last"]) for d in listed]))
            return pd.DataFrame([m or (None,) * 4 for m in out], columns=["distance", "budget", "word_edits", "start"]).astype("Int32")

        found = beside.select("uid", "item_id", best("line", "text", "diagonals").alias("met"))
        return found.select("uid", "item_id", "met.*").filter(F.col("distance").isNotNull())


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, item_id, distance, budget, word_edits, start): one row for each document and item that it holds.

    An item is held if a passage of it, any run of sixteen or twenty-four words or all of a shorter item, is met

    - with at most one byte edit less than it has pieces of sixteen bytes, or
    - with one word replaced, left out or put in, if it has 48 bytes and sixteen of them on one side of
      that word; ``word_edits`` is 1 then, and ``distance`` the bytes that differ.

    A passage below 32 bytes has no edits and stands between words, an item below 24 bytes is only held
    by a document that is the item. ``start`` is the byte of the normal text where the passage met best
    begins, about. A null or empty document holds nothing, nor is a null or empty item held; repeated
    items and documents are each reported, null ids like others. Documents of any length are looked at
    whole. Other columns are not used; an empty table on either side gives an empty result.
    """
    items = Benchmark(benchmark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = items.scanned(rows, "text", "places").filter(F.col("places.line").isNotNull())
    marked = materialise(marked.select("id", F.monotonically_increasing_id().alias("uid"), "places.*"), "suspects")
    found = items.held(marked).join(marked.select("uid", "id"), "uid")
    return found.select(F.col("id").alias(id_col), "item_id", "distance", "budget", "word_edits", "start")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, as ``leaks`` says, with their columns as they are.

    Rows are decided on by themselves: null and empty texts stay, repeated rows stay or go together. Only
    rows with a possible hit meet the benchmark; the others go through without a shuffle. Names of columns
    do not matter, and an empty table or benchmark changes nothing.
    """
    columns, items = docs.columns, Benchmark(benchmark)
    places, uid = fresh_name(docs, "_places"), fresh_name(docs, "_uid")
    marked = items.scanned(docs, text_col, places).withColumn(uid, F.monotonically_increasing_id())
    marked = materialise(marked, "marked")
    suspected = F.col(f"{places}.line").isNotNull()
    suspects = marked.filter(suspected)
    holding = items.held(suspects.select(F.col(uid).alias("uid"), f"{places}.*")).select(F.col("uid").alias(uid)).distinct()
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return marked.filter(~suspected).select(kept).union(suspects.join(holding, uid, "left_anti").select(kept))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
