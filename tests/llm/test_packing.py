"""Best-fit packing: every word once, room and conflicts kept, the search against a plain scan, odd rows."""

import random
from collections import Counter, defaultdict

import pytest

from slotmill.llm import packing
from slotmill.llm.simhash import near_copies

SF = "/root/testdata/sf0.01"


def plain_pack(sizes, sources, clusters, capacity):
    bins, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [
            (b["room"], n) for n, b in enumerate(bins)
            if b["room"] >= sizes[i] and (sources[i] is None or sources[i] not in b["s"]) and (clusters[i] is None or clusters[i] not in b["c"])
        ]
        if sizes[i] == capacity or not fits:
            bins.append({"room": capacity, "s": set(), "c": set(), "n": 0})
            n = len(bins) - 1
        else:
            n = min(fits)[1]
        out[i] = (n, bins[n]["n"], capacity - bins[n]["room"])
        bins[n]["room"] -= sizes[i]
        bins[n]["n"] += 1
        bins[n]["s"].add(sources[i])
        bins[n]["c"].add(clusters[i])
    return out


@pytest.mark.parametrize("kinds", [2, 7, 30, 400])
def test_tightest_compatible_bin(kinds):
    rng = random.Random(kinds)
    n = 400
    sizes = [min(100, max(1, int(rng.expovariate(1 / 30)))) for _ in range(n)]
    sources = [None if rng.random() < 0.05 else min(rng.randrange(kinds), rng.randrange(kinds)) for _ in range(n)]
    clusters = [None if rng.random() < 0.2 else rng.randrange(200) for _ in range(n)]
    assert packing.pack_lot(sizes, sources, clusters, 100) == plain_pack(sizes, sources, clusters, 100)


def verify(rows, found, capacity):
    """``rows``: (id, text, source) with distinct ids."""
    words = {d: len((t or "").encode().split()) for d, t, _ in rows}
    text, source = {d: t for d, t, _ in rows}, {d: s for d, _, s in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append((r.start_word, r.n_words))
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
        else:
            assert r.n_words == 0
    assert set(pieces) == set(words)
    for doc, spans in pieces.items():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at == words[doc]
    for inside in bins.values():
        inside.sort(key=lambda r: r.position)
        assert [r.position for r in inside] == list(range(len(inside)))
        at = 0
        for r in inside:
            assert r.offset == at
            at += r.n_words
        assert 0 < at <= capacity
        named = [source[r.doc_id] for r in inside if source[r.doc_id] is not None]
        assert len(named) == len(set(named))
        assert len(inside) == len({text[r.doc_id] for r in inside})
    return bins


@pytest.mark.parametrize("lot_pieces", [packing.LOT_PIECES, 60])
def test_all_documents(spark, lot_pieces):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    bins = verify(rows, packing.packed(docs, 512, lot_pieces=lot_pieces).collect(), 512)
    words = sum(len(t.split()) for _, t, _ in rows)
    assert len(bins) < 1.25 * max(words / 512, max(Counter(s for *_, s in rows).values())) + len(rows) / lot_pieces


def test_query(spark):
    found = packing.op2_best_fit_packing(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verify([(r.doc_id, r.text, r.source) for r in docs.collect()], found.collect(), 2048)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n", None), (4, "x " * 25, "a"), (5, "y " * 7, None), (6, "z " * 3, "a"), (7, "q", "b"), (8, "q", "c")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, piece int, Lot int")
    bins = verify(rows, packing.packed(frame, 10).collect(), 10)
    assert len(bins) == 5
    same = spark.createDataFrame([(None, "a b", "s")] * 3 + [(1, "a b", None)] * 2, "doc_id long, text string, source string")
    out = packing.packed(same, 10).collect()
    assert len(out) == 5 and len({r.bin_id for r in out}) == 5
    joined = packing.packed(same.selectExpr("*", "cast(null as string) AS c"), 10, source_col=None, cluster_col="c").collect()
    assert len({r.bin_id for r in joined}) == 1
    assert packing.packed(frame.filter("false"), 10).collect() == []


def test_near_copies_of_several_sources_part(spark):
    rng = random.Random(8)
    base = [f"word{rng.randrange(5000)}" for _ in range(400)]
    near = base[:200] + ["other"] + base[201:]
    apart = [f"word{rng.randrange(5000)}" for _ in range(400)]
    rows = [(1, " ".join(base), "a"), (2, " ".join(near), "b"), (3, " ".join(apart), "c"), (None, " ".join(near), "d"), (5, None, "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bins = {r.doc_id: r.bin_id for r in packing.packed(frame, 2048, near_bits=4).collect()}
    assert len({bins[1], bins[2], bins[None]}) == 3 and bins[3] in (bins[1], bins[2], bins[None]) and bins[5] is None
    assert packing.packed(frame.filter("false"), 2048, near_bits=4).collect() == []


def test_query_parts_near_copies(spark):
    component = {r.doc_id: r.component for r in near_copies(spark.read.parquet(f"{SF}/documents.parquet"), words=4, max_bits=4).collect()}
    inside = defaultdict(list)
    for r in packing.op2_best_fit_packing(spark, SF).collect():
        if r.bin_id is not None:
            inside[r.bin_id].append(component[r.doc_id])
    assert all(len(c) == len(set(c)) for c in inside.values())
