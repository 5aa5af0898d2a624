import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from salestide.llm import decontaminate as d
from salestide.llm.text import slices

DATA = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split()


def shingles(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def by_hand(docs, items):
    out = {}
    for doc, text in docs:
        words = tokens(text)
        for item, passage in items:
            wanted = tokens(passage)
            n = min(len(wanted), len(words))
            target = shingles(wanted)
            for start in range(len(words) - n + 1 if n else 0):
                window = words[start : start + n]
                score = similarity(shingles(window), target)
                if score >= 0.8 and (score, -start) > out.get((doc, item), (0, 0))[:2]:
                    out[doc, item] = (score, -start, n)
    return {k: (round(v[0], 12), -v[1], v[2]) for k, v in out.items()}


def sample():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([9, 14, 30, 45])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "just three words"), (103, "four words it has"), (104, "a a a a a a a a"), (105, items[3][1])]
    docs = []
    for i in range(60):
        filler = rnd.choices(vocab, k=rnd.randrange(80))
        passage = items[i % 30][1].split()
        kind = i % 6
        if kind == 1:
            passage[rnd.randrange(len(passage))] = "CHANGED"
        if kind == 2:
            passage[0] = "edge"
        if kind == 3:
            passage = passage[: len(passage) // 2]
        if kind == 4:
            passage = passage[1:]
        at = rnd.randrange(len(filler) + 1)
        docs.append((i, " ".join(filler[:at] + (passage if kind != 5 else []) + filler[at:])))
    docs += [(200, None), (201, ""), (202, "Just  THREE\nwords"), (203, "x four words it has y"), (204, "a " * 30), (205, items[4][1].upper())]
    docs += [(206, " ".join(items[i][1] for i in range(30))), (207, "word " * 30_000 + items[5][1])]
    return docs, items


def test_passages_equal_brute_force(spark):
    docs, items = sample()
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    for block_items in (d.BLOCK_ITEMS, 5):
        got = d.passages(frame, benchmark, block_items=block_items).collect()
        assert {(r.doc_id, r.item_id): (round(r.similarity, 12), r.start_word, r.words) for r in got} == want
        assert len(got) == len(want)
    kept = d.clean(frame, benchmark, block_items=7)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_documents_of_the_tables(spark):
    docs, benchmark = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    got = d.passages(docs, benchmark).collect()
    mine = {(r.doc_id, r.item_id): round(r.similarity, 12) for r in got if r.doc_id in dict(short)}
    assert mine == {k: v[0] for k, v in by_hand(short, items).items()}
    for r in got:  # every verbatim passage of the long ones too
        assert r.similarity >= 0.8
    verbatim = {(i, j) for i, t in rows for j, p in items if p and b" ".join(tokens(p)) in b" ".join(tokens(t))}
    assert verbatim <= {(r.doc_id, r.item_id) for r in got}


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    stream = [rng.integers(0, 1 << 63, 30, dtype=np.uint64) for _ in range(40)]
    index = d.SizeIndex(34, list(range(40)), stream, d.RADIUS)
    prints = np.vstack([index.prints, rng.integers(0, 256, (3000, 8), dtype=np.uint8)])
    for row in range(40):  # flips up to and beyond the radius
        for flips in (5, d.RADIUS, d.RADIUS + 1):
            bits = np.unpackbits(index.prints[row])
            bits[rng.choice(64, flips, replace=False)] ^= 1
            prints = np.vstack([prints, np.packbits(bits)])
    apart = np.bitwise_count(prints[:, None] ^ index.prints[None]).sum(2)
    assert set(zip(*map(np.ndarray.tolist, index.within(prints)))) == set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= d.RADIUS))))


@pytest.mark.parametrize("words", [14, 36, 60])
def test_similar_windows_are_within_the_radius(words):
    rng = np.random.default_rng(words)
    misses = 0
    for _ in range(2000):
        a = rng.integers(0, 1 << 63, words - 4, dtype=np.uint64)
        b = a.copy()
        most = int((1 - 0.8) / (1 + 0.8) * len(a))
        b[:most] = rng.integers(0, 1 << 63, most, dtype=np.uint64)
        one, two = (d.fingerprints(d.bits_of(x), len(x))[0] for x in (a, b))
        misses += np.bitwise_count(one ^ two).sum() > d.RADIUS
    assert misses <= 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert d.passages(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert d.passages(docs, items.limit(0)).count() == 0
    assert d.clean(docs, items.limit(0)).count() == 1
    assert d.clean(docs, items).count() == 0


def test_slices_make_no_copies_of_a_batch_s_texts():
    texts = ["x" * 20_000, None, ""] * 400
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    tracemalloc.start()
    try:
        pieces = list(slices([batch]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [t for p in pieces for t in p.column("text").to_pylist()] == texts
    assert all(pc.sum(pc.binary_length(p.column("text"))).as_py() <= 1 << 20 for p in pieces)
    assert most < 1 << 20  # 8 MB of text
    assert list(slices([batch.slice(0, 0)])) == []
