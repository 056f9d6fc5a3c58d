"""Collocations from word suffix trees that are built in groups of prefixes.

The corpus is the string of all words, and every word begins a suffix that ends
after five words or with its piece. Suffixes are partitioned by their first
words: a prefix whose suffixes are more than a memory budget gets another word,
and prefixes are then gathered into groups of about that budget. The subtree of
a group needs nothing from other groups; the count of a phrase is the sum of
the leaves below its node.

A phrase is as frequent as its parts at most. So words are counted first, then
pairs of words, and a suffix ends where a word or a pair is too rare. What is
frequent goes to the tasks as a bit filter of fixed size. Pairs are only counted
by their place in that filter, which is never less than the count of a pair. A
hit that is none leaves a suffix longer than it had to be; all counts of phrases
come from the suffixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotmill.llm.common import materialise, table

#: words of the longest phrase, which is the depth of the trees
DEPTH = 5
#: occurrences of a phrase
MIN_COUNT = 100
#: phrases that are returned for each language
TOP = 2000
#: a phrase goes if a longer one that holds it has this share of its occurrences
CONTAINED_PERCENT = 100
#: leaves of a group's subtrees, about
BUDGET = 1 << 14
#: words that a task holds before it adds them up
HELD_WORDS = 1 << 20
#: bytes of text that are split at a time
SPAN = 1 << 20
#: bits of the filter of frequent words and pairs, and those that one row holds while it is made
FILTER_BITS, BUCKET = 1 << 26, 1 << 15
#: parts of a language that are ranked by themselves first
RANK_PARTS = 64

UNKNOWN = "und"
#: what ends a piece; a space ends a word
BREAK = b"\n"


def _cleaning() -> bytes:
    table_ = bytearray(range(256))
    table_[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    for sign in b".,;:!?\x0a\x0b\x0c\x0d":
        table_[sign] = BREAK[0]
    table_[ord("\t")] = ord(" ")
    return bytes(table_)


CLEANING = _cleaning()


def split_words(text: bytes, span: int = SPAN) -> Iterator[list[bytes]]:
    """Words of a text in order, with ``BREAK`` between pieces, and empty words; in lists of about ``span`` bytes."""
    start = 0
    while start < len(text):
        end = start + span
        # a cut lies before a space or break, so it never goes through a word
        part = text[start:end].translate(CLEANING)
        while end < len(text) and text[end : end + 1].translate(CLEANING) not in (b" ", BREAK):
            more = text[end : end + span].translate(CLEANING)
            at = min((i for i in (more.find(b" "), more.find(BREAK)) if i >= 0), default=len(more))
            part, end = part + more[:at], end + at
        yield part.replace(BREAK, b" \n ").split(b" ")
        start = end


class Filter:
    """Bits of what may be frequent; all that is frequent has its bit."""

    def __init__(self, rows: Iterator):
        """From rows (bucket, bits), each the bits of ``BUCKET`` places; of fixed size, whatever they stand for."""
        packed = bytearray(FILTER_BITS // 8)
        for row in rows:
            packed[row.bucket * BUCKET // 8 : (row.bucket + 1) * BUCKET // 8] = row.bits
        self.packed = bytes(packed)

    @staticmethod
    def of_words(words: DataFrame) -> Filter:
        """From (lang, phrase)."""
        place = F.pmod(F.crc32(F.concat_ws("\n", "lang", "phrase").cast("binary")), F.lit(FILTER_BITS)) + 1
        bucket = (F.bitmap_bucket_number("place") - 1).alias("bucket")
        rows = words.select(place.alias("place")).groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        return Filter(rows.toLocalIterator())

    def has(self, crc: int) -> bool:
        at = crc % FILTER_BITS
        return bool(self.packed[at >> 3] >> (at & 7) & 1)

    def has_places(self, places: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.packed, np.uint8)[places >> 3] >> (places & 7).astype(np.uint8) & 1 != 0


class Ids(dict):
    """Numbers for words from 1 on; 0 for a break and, with a filter, for words that are too rare; -1 for the empty word."""

    def __init__(self, lang: bytes, filter_: Filter | None):
        super().__init__({b"": -1, BREAK: 0})
        self.start, self.filter = zlib.crc32(lang + b"\n"), filter_
        self.words: list[bytes] = [BREAK]
        self.crcs: list[int] = [0]

    def __missing__(self, word: bytes) -> int:
        crc = zlib.crc32(word, self.start)
        number = 0
        if self.filter is None or self.filter.has(crc):
            number = len(self.words)
            self.words.append(word)
            self.crcs.append(crc)
        self[word] = number
        return number


class Corpus:
    """The words of one language in a task: numbers that are held until there are enough to add up."""

    def __init__(self, lang: bytes, words_filter: Filter | None, held_words: int):
        self.lang, self.filter, self.most = lang, words_filter, held_words
        self.restart([])

    def restart(self, words: list[bytes]) -> None:
        self.ids = Ids(self.lang, self.filter)
        self.parts = [np.array([self.ids[w] for w in words], np.int64)]
        self.held = len(words)

    def add(self, text: bytes) -> Iterator[tuple[Ids, np.ndarray, int]]:
        """Takes a text in; yields (ids, numbers, starts) when enough is held."""
        for words in split_words(text):
            numbers = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            numbers = numbers[numbers >= 0]
            self.parts.append(numbers)
            self.held += len(numbers)
            if self.held >= self.most:
                yield self.take(DEPTH - 1)
        self.parts.append(np.zeros(1, np.int64))
        self.held += 1

    def take(self, kept: int = 0) -> tuple[Ids, np.ndarray, int]:
        """What is held, of which the last ``kept`` numbers are only looked at and stay; breaks follow the end."""
        numbers, ids = np.concatenate(self.parts), self.ids
        kept = min(kept, len(numbers))
        starts = len(numbers) - kept
        self.restart([ids.words[i] for i in numbers[starts:]])
        return ids, np.concatenate([numbers, np.zeros(DEPTH, np.int64)]), starts


def count_words(ids: Ids, numbers: np.ndarray, starts: int) -> Iterator[tuple[bytes, int]]:
    counts = np.bincount(numbers[:starts], minlength=len(ids.words))
    return ((ids.words[i], int(counts[i])) for i in np.flatnonzero(counts) if i)


def _pairs(ids: Ids, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which two words follow each other, and the place of the pair in the filter."""
    at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
    crc = np.array(ids.crcs, np.uint64)
    mixed = crc[numbers[at]] * np.uint64(0x9E3779B97F4A7C15) + crc[numbers[at + 1]] * np.uint64(0xC2B2AE3D27D4EB4F)
    return at, ((mixed ^ mixed >> np.uint64(31)) % np.uint64(FILTER_BITS)).astype(np.int64)


def count_suffixes(pairs_filter: Filter) -> Callable[[Ids, np.ndarray, int], Iterator[tuple[bytes, int]]]:
    """Suffixes of two words and more that end before the first pair that is too rare."""

    def of(ids: Ids, numbers: np.ndarray, starts: int) -> Iterator[tuple[bytes, int]]:
        at, places = _pairs(ids, numbers)
        goes_on = np.zeros(len(numbers) + DEPTH, bool)
        goes_on[at] = pairs_filter.has_places(places)
        start = np.flatnonzero(goes_on[:starts])
        if not len(start):
            return
        padded = np.concatenate([numbers, np.zeros(DEPTH, np.int64)])
        tree, alive = [padded[start]], np.ones(len(start), bool)
        for depth in range(1, DEPTH):
            alive = alive & goes_on[start + depth - 1]
            tree.append(np.where(alive, padded[start + depth], 0))
        order = np.lexsort(tree[::-1])
        tree = np.array(tree)[:, order]
        new = np.flatnonzero(np.concatenate([[True], (tree[:, 1:] != tree[:, :-1]).any(axis=0)]))
        for path, count in zip(tree[:, new].T.tolist(), np.diff(np.append(new, len(start))).tolist()):
            yield b" ".join([ids.words[i] for i in path if i]), count

    return of


def read_words(
    batches: Iterator[pa.RecordBatch], words_filter: Filter | None, held_words: int
) -> Iterator[tuple[bytes, Ids, np.ndarray, int]]:
    """(lang, ids, numbers, starts) of the words of a task, about ``held_words`` of all languages at a time."""
    held: dict[bytes, Corpus] = {}
    total = 0
    for batch in batches:
        langs, texts = (batch.column(name).cast(pa.binary()) for name in ("lang", "text"))
        for lang, text in zip(langs, texts):
            name = lang.as_py()
            if name not in held:
                held[name] = Corpus(name, words_filter, held_words)
            total -= held[name].held
            for taken in held[name].add(text.as_py()):
                yield name, *taken
            total += held[name].held
            if total >= held_words:
                for corpus in held.values():
                    yield corpus.lang, *corpus.take()
                held, total = {}, 0
    for corpus in held.values():
        yield corpus.lang, *corpus.take()


def counted(docs: DataFrame, count: Callable, words_filter: Filter | None = None, held_words: int = HELD_WORDS) -> DataFrame:
    """(lang, phrase, f) of what ``count`` finds in the texts of ``docs`` (lang, text), added up over all of them."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, *taken in read_words(batches, words_filter, held_words):
            found = list(count(*taken))
            if found:
                langs = pa.array([lang] * len(found), pa.binary()).cast(pa.string())
                phrases = pa.array([p for p, _ in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs, phrases, pa.array([n for _, n in found], pa.int64())], schema=schema)

    return docs.mapInArrow(tally, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_pairs(docs: DataFrame, words_filter: Filter, min_count: int, held_words: int = HELD_WORDS) -> Filter:
    """The places of pairs of words that come ``min_count`` times or more.

    What a task has counted goes out as one row for each bucket of places. The rows of a bucket are added up
    one after the other, so a task holds the counts of one bucket.
    """
    kind = np.uint16 if min_count < 1 << 16 else np.uint32
    schema = pa.schema([("bucket", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
    summed = pa.schema([("bucket", pa.int32()), ("bits", pa.binary())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, numbers, starts in read_words(batches, words_filter, held_words):
            at, places = _pairs(ids, numbers)
            found, counts = np.unique(places[at < starts], return_counts=True)
            counts = np.minimum(counts, min_count).astype(kind)  # more makes no difference
            buckets, first = np.unique(found // BUCKET, return_index=True)
            low = (found % BUCKET).astype(np.uint16)
            ends = np.append(first[1:], len(found))
            parts = [[values[a:b].tobytes() for a, b in zip(first, ends)] for values in (low, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, total = None, np.zeros(BUCKET, np.int64)

        def bits() -> pa.RecordBatch:
            packed = np.packbits(total >= min_count, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([packed], pa.binary())], schema=summed)

        for batch in batches:
            for number, places, counts in zip(*[column.to_pylist() for column in batch.columns]):
                if number != bucket:
                    if bucket is not None:
                        yield bits()
                    bucket = number
                    total[:] = 0
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, kind)
        if bucket is not None:
            yield bits()

    parts = docs.mapInArrow(tally, "bucket int, places binary, counts binary")
    rows = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, "bucket int, bits binary")
    return Filter(rows.toLocalIterator())


def vertical_groups(suffixes: DataFrame, budget: int) -> DataFrame:
    """``suffixes`` (lang, phrase, f) with the depth of the prefix that each is partitioned by, and its group.

    A prefix with more suffixes than the budget gets another word, up to the whole suffix, of which there
    is one. Prefixes are dealt into lots of about a budget, and a lot is cut into groups where the budget
    is reached, so a group has less than two of them.
    """
    deep = suffixes.withColumn("depth", F.lit(2))
    prefix = F.expr("substring_index(phrase, ' ', depth)").alias("prefix")
    for depth in range(2, DEPTH):
        at_depth = deep.filter(F.col("depth") == depth).groupBy("lang", prefix)
        # no more rows than suffixes by the budget
        heavy = materialise(at_depth.count().filter(F.col("count") > budget).select("lang", "prefix", F.lit(1).alias("heavy")), "heavy")
        if heavy.isEmpty():
            break
        deep = deep.withColumn("prefix", prefix).join(heavy, ["lang", "prefix"], "left").drop("prefix")
        deep = deep.withColumn("depth", F.col("depth") + F.coalesce("heavy", F.lit(0))).drop("heavy")
    deep = deep.withColumn("prefix", prefix)
    lots = max(1, -(-suffixes.count() // budget))
    lot = F.pmod(F.xxhash64("lang", "prefix"), F.lit(lots)).alias("lot")
    weights = deep.groupBy("lang", "prefix").agg(F.count("*").alias("weight")).select("lang", "prefix", "weight", lot)
    before = F.sum("weight").over(Window.partitionBy("lot").orderBy("lang", "prefix")) - F.col("weight")
    groups = weights.select("lang", "prefix", "lot", F.floor(before / budget).alias("number"))
    return deep.join(groups, ["lang", "prefix"]).drop("prefix")


def subtree_counts(leaves: pa.Table, min_count: int) -> pa.Table:
    """(lang, phrase, f) of the nodes of a group's subtrees: those frequent enough, and those above a prefix's depth.

    The leaves (lang, phrase, f, depth) are put in the order of a walk through the tree. A node of some depth
    is a run of leaves that agree so far, and its count is their total. A node above the depth of its prefix
    may have leaves in other groups, so it is handed on whatever its count.
    """
    langs, paths = leaves.column("lang").to_pylist(), [phrase.split(" ") for phrase in leaves.column("phrase").to_pylist()]
    numbers: dict[str, int] = {}
    codes = np.full((len(paths), DEPTH + 1), -1, np.int64)
    codes[:, 0] = [numbers.setdefault(lang, len(numbers)) for lang in langs]
    for row, path in enumerate(paths):
        codes[row, 1 : len(path) + 1] = [numbers.setdefault(word, len(numbers)) for word in path]
    order = np.lexsort(codes.T[::-1])
    codes, counts, depths = codes[order], leaves.column("f").to_numpy()[order], leaves.column("depth").to_numpy()[order]
    turns = np.cumsum(codes[1:] != codes[:-1], axis=1) > 0
    found: tuple[list, list, list] = ([], [], [])
    for depth in range(2, DEPTH + 1):
        first = np.flatnonzero(np.concatenate([[True], turns[:, depth]]))
        f = np.add.reduceat(counts, first)
        node = codes[first, depth] >= 0
        node &= (f >= min_count) | (np.maximum.reduceat(depths, first) > depth)
        at = order[first[node]].tolist()
        found[0].extend(langs[i] for i in at)
        found[1].extend(" ".join(paths[i][:depth]) for i in at)
        found[2].extend(f[node].tolist())
    kinds = {"lang": pa.string(), "phrase": pa.string(), "f": pa.int64()}
    return pa.Table.from_pydict(dict(zip(kinds, found)), schema=pa.schema(kinds))


def phrase_counts(docs: DataFrame, min_count: int, budget: int, held_words: int = HELD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, phrase, k, f) of all phrases of one to five words that are frequent."""
    words = materialise(counted(docs, count_words, held_words=held_words), "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = words.filter(F.col("f") >= min_count)
    words_filter = Filter.of_words(frequent)
    pairs_filter = frequent_pairs(docs, words_filter, min_count, held_words)
    suffixes = materialise(counted(docs, count_suffixes(pairs_filter), words_filter, held_words), "suffixes")
    grouped = vertical_groups(suffixes, budget).groupBy("lot", "number")

    def build(leaves: pa.Table) -> pa.Table:
        return subtree_counts(leaves, min_count)

    nodes = grouped.applyInArrow(build, "lang string, phrase string, f long")
    phrases = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    both = frequent.select("lang", "phrase", "f").union(phrases)
    return totals, materialise(both.withColumn("k", F.size(F.split("phrase", " "))), "phrases")


def scored(totals: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of the phrases of two words and more, each by its weakest cut."""
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = phrases.filter("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), cut)
    cuts = cuts.select(
        "*",
        F.expr("substring_index(phrase, ' ', cut)").alias("first"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # products of counts below 10^17 fit the 38 digits
    wide = {name: F.col(name).cast("decimal(38,0)") for name in ("a", "n", "l", "r")}
    score = F.expr("(wide.a * wide.n * 1000BD) div (wide.l * wide.r)")
    known = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    known = known.withColumn("wide", F.struct(*[c.alias(n) for n, c in wide.items()])).withColumn("score", score)
    weakest = F.min(F.struct("score", "cut", "l", "r")).alias("weakest")
    found = known.groupBy("lang", "phrase", "k", "a", "n").agg(weakest)
    return found.select("lang", "phrase", "k", "a", "weakest.l", "weakest.r", "n", "weakest.score")


def uncontained(candidates: DataFrame, percent: int) -> DataFrame:
    """Without the phrases of which a longer candidate has that share.

    If any longer one has, then so has one that is longer by a word, since counts fall along the way.
    """
    shorter = F.explode(F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)")))
    longer = candidates.filter("k >= 3").select("lang", shorter.alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    return candidates.join(most, ["lang", "phrase"], "left").filter(kept).drop("longer")


def best(candidates: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank; parts of a language are cut to ``top`` before they meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    cut = candidates.withColumn("part", part).withColumn("rank", in_part).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return cut.withColumn("rank", rank).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
    budget: int = BUDGET,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases whose parts belong together most.

    Words are separated by spaces and tabs and phrases never go over a line end or one of ``.,;:!?``;
    A-Z are lower-cased. ``a`` counts all occurrences of a phrase of two to five words, ``l`` and ``r``
    those of its parts at the weakest cut, ``n`` all words of the language. Ties are broken by ``a`` and
    then by the phrase's bytes, so ranks are repeatable.

    A null text is empty, a null language is ``und`` like that name itself. Repeated rows count each
    time, ids and other columns are not used, and a text of any length is read in spans. An empty table
    gives an empty result.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    totals, phrases = phrase_counts(rows, min_count, budget, held_words)
    kept = uncontained(scored(totals, phrases), contained_percent)
    return best(kept, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


#: the same by listing every phrase
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, row_number() OVER () AS number, regexp_extract_all(piece, '[^ \t]+') AS list FROM pieces
), words AS (
  SELECT lang, number, unnest(list) AS w, unnest(range(len(list))) AS i FROM lists
), following AS (
  SELECT lang, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS d, lead(w, 4) OVER o AS e
  FROM words WINDOW o AS (PARTITION BY number ORDER BY i)
), occurrences AS (
  SELECT lang, 1 AS k, a AS phrase FROM following
  UNION ALL SELECT lang, 2, a || ' ' || b FROM following WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM following WHERE c IS NOT NULL
  UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM following WHERE d IS NOT NULL
  UNION ALL SELECT lang, 5, a || ' ' || b || ' ' || c || ' ' || d || ' ' || e FROM following WHERE e IS NOT NULL
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM occurrences GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.a, x.cut, l.f AS l, r.f AS r, n,
    (1000::HUGEINT * c.a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM candidates c JOIN (SELECT unnest(range(1, 5)) AS cut) x ON x.cut < c.k
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:x.cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[x.cut + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT DISTINCT c.lang, c.a, array_to_string(c.w[i:i + m - 1], ' ') AS part
  FROM candidates c, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS i)
  WHERE m < c.k AND i + m - 1 <= c.k
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest w
WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.lang = w.lang AND p.part = w.phrase AND 100 * p.a >= 100 * w.a)
QUALIFY rank <= 2000
"""
