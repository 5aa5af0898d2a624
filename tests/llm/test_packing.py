import random
import time
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salestide.llm import packing
from salestide.llm import tokens
from salestide.llm.tokens import encoder

DATA = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a b", "a  b", "a \n b", "a\n\nb c", "a\n b", "a\nb c\nd", "\na b", "a b\n", "a b\t c d",
    "a b c  d", "it's we'll 'tis O'Neill's x", "1234 56a7 ...!? a", "a　b 　c d", "é è 日本 語 \U0001f600 x", "a\r\nb c", "a \x1c b c\x1c d",
    "a\x85b \x85 c", "<|endoftext|> x", "a<|endoftext|>b <|endoftext|>", "<|endoftext|", "x  <|endoftext|>\n y", "A" * 5000, "x " * 3000, "a\x00b \x00 c", "ǅ ₂ x² ½ Ⅷ", "a ​ b",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_tokenizer(text, plain):
    assert ids(encoder().encode(text)) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\t", "a", "the", "B.", "é", "9", "'s", "--", " ", "\x0b", "日", "'"]), max_size=14).map("".join))
def test_ids_equal_the_tokenizer_on_mixtures(plain, text):
    assert ids(encoder().encode(text)) == plain(text)


def test_a_full_cache_goes_on_with_the_words_met_first(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 40)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 20, raising=False)
    fresh, common = encoder.__wrapped__(), [f"c{i}" for i in range(20)]
    for text in [" ".join(["x", *common]), *(" ".join(["x", *common, *(f"r{i}-{j}" for j in range(n))]) for i, n in enumerate((5, 15, 30, 90, 1)))]:
        assert ids(fresh.encode(text)) == plain(text)
        assert len(fresh._words) <= 40 and fresh._words.keys() >= set(common)


def test_ids_equal_the_tokenizer_on_documents(plain):
    for (text,) in duckdb.sql(f"select text from '{DATA}'").fetchall():
        assert ids(encoder().encode(text or "")) == plain(text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_packs_are_whole_and_no_worse_than_best_fit(sizes):
    before = packing.best_fit(sizes, 64)
    after = packing.local_search(sizes, before, 64)
    assert sorted(p for b in after for p in b) == list(range(len(sizes)))
    fills = [[sum(sizes[p] for p in b) for b in bins] for bins in (before, after)]
    assert all(0 < f <= 64 for f in fills[1]) and len(after) <= len(before)
    assert sum(f * f for f in fills[1]) >= sum(f * f for f in fills[0])


def test_local_search_empties_bins():
    sizes = [6, 6, 5, 5, 4, 4]
    bad = [[0, 2], [1, 3], [4], [5]]  # 11, 11, 4, 4 of 15
    assert len(packing.local_search(sizes, bad, 15)) == 2


@pytest.mark.parametrize("sizes", [[400] * 16_384, [513] * 16_384, [300, 724] * 8_192, [350, 341] * 8_192])
def test_equal_lengths_take_no_longer(sizes):
    began = time.perf_counter()
    bins = packing.pack_sizes(sizes)
    assert time.perf_counter() - began < 5
    assert sorted(p for b in bins for p in b) == list(range(len(sizes)))


def test_pick_is_the_emptiest_bin(rnd=random.Random(3)):
    """After any exchange, a piece of a size is in the emptiest bin that has one."""
    sizes = [rnd.randint(1, 30) for _ in range(300)]
    bins = packing.best_fit(sizes, 40)
    fill = [sum(sizes[p] for p in b) for b in bins]
    rest = packing._Emptier(sizes, bins, fill)
    for number, members in enumerate(bins):
        for piece in members:
            rest.add(piece, number)
    for _ in range(400):
        size = sizes[rnd.choice([p for b in bins for p in b])]
        piece, number = rest.pick(size)
        assert (fill[number], piece) == min((fill[n], p) for n, b in enumerate(bins) for p in b if sizes[p] == size)
        rest.remove(piece)
        bins[number].remove(piece)
        fill[number] -= size
        rest.emptied(number)
        if sum(map(len, bins)) < 50:
            break


def check(rows, texts, plain, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        whole = plain(texts[key] or "") + [packing.END_ID]
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert len(pieces) == max(1, -(-len(whole) // capacity))
        at = 0
        for i, r in enumerate(pieces):
            assert r.start == at and (i == 0 or r.length == capacity)
            part = np.array(whole[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(whole)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents_come_back_whole(spark, plain, monkeypatch):
    docs = spark.read.parquet(DATA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    total = sum(len(plain(t or "")) + 1 for t in texts.values())
    rows = packing.pack(docs.repartition(3)).collect()
    assert check(rows, texts, plain, 1024) <= -(-total // 1024) + 2
    assert check(packing.pack(docs, capacity=100).collect(), texts, plain, 100) <= 1.02 * total / 100 + 2
    monkeypatch.setattr(packing, "GROUP_PIECES", 16)  # many groups and several rounds of pooling
    monkeypatch.setattr(packing, "POOL_BELOW", 1.0)
    assert check(packing.pack(docs.repartition(4)).collect(), texts, plain, 1024) <= 1.02 * total / 1024 + 2


def test_odd_rows_and_sequences(spark, plain):
    rows = [(1, None), (2, ""), (3, "a b " * 4000), (None, "x"), (5, "x y z")]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, fill string")
    packed = packing.pack(docs, keep_ids=True)
    got = packed.collect()
    check(got, dict(rows), plain, 1024)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    assert packing.pack(twice).count() == 3
    for sequence in packing.sequences(packed).collect():
        members = sorted((r.offset, r.ids) for r in got if r.sequence_id == sequence.sequence_id)
        assert sequence.ids == b"".join(i for _, i in members) and sequence.tokens * 4 == len(sequence.ids)
    assert packing.pack(docs.limit(0)).count() == 0
