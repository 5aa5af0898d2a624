import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salestide.llm import ngram_join, trie
from salestide.llm.components import connected

DATA = "/root/testdata/sf0.001/documents.parquet"


def shingles(text, size=3):
    words = (text or "").encode().lower().split()
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def link(a, b, share=90):
    return bool(a) and 100 * len(a & b) >= share * len(a | b)


def components_by_hand(rows, size=3, share=90):
    sets = [shingles(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if link(sets[i], sets[j], share):
                top[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [k for j, (k, _) in enumerate(rows) if find(j) == find(i) and k is not None]
        out.append((key, len(sets[i]), min(keys) if keys else None))
    return sorted(out, key=repr)


def compare(got, rows, size=3, share=90):
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == components_by_hand(rows, size, share)


sets_of_tokens = st.lists(st.sets(st.integers(0, 40), min_size=0, max_size=30), max_size=14)


@settings(max_examples=300, deadline=None)
@given(sets_of_tokens, st.integers(0, 1000), st.sampled_from([90, 80, 50]))
def test_trie_finds_the_linked_pairs(sets, seed, share):
    rnd = random.Random(seed)
    for s in list(sets):  # near copies
        s = set(s)
        if s and rnd.random() < 0.7:
            s.discard(rnd.choice(sorted(s)))
            if rnd.random() < 0.5:
                s.add(rnd.randrange(40))
            sets.append(s)
    distinct = [set(x) for x in {frozenset(s) for s in sets}]
    arrays = [np.array(sorted(s), np.uint64) for s in distinct]
    want = {(i, j) for j in range(len(distinct)) for i in range(j) if link(distinct[i], distinct[j], share)}
    assert set(trie.pairs(arrays, [len(a) for a in arrays], share)) == want
    prefixes = [a[: trie.prefix_length(len(a), share)] for a in arrays]
    assert want <= set(trie.pairs(prefixes, [len(a) for a in arrays], share))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sets(st.integers(0, 1 << 40), min_size=1, max_size=150), min_size=1, max_size=8), st.integers(0, 1000), st.sampled_from([90, 80, 50]))
def test_parities_lose_no_link(sets, seed, share):
    rnd = random.Random(seed)
    for s in list(sets):  # near copies, some over another number of slots
        sets.append(s | {rnd.randrange(1 << 40) for _ in range(rnd.randrange(1 + len(s) // 4))})
        sets.append(set(sorted(s)[: max(1, len(s) * rnd.randrange(50, 101) // 100)]))
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if link(sets[i], sets[j], share)}
    assert want <= set(ngram_join.may_link([ngram_join.parities(a) for a in arrays], [len(a) for a in arrays], share))


def test_parities_tell_sets_apart_that_share_a_prefix():
    """Of these a trie of prefixes would look at all pairs; a set's parities are a fraction of its prefix."""
    rng = np.random.default_rng(0)
    shared = rng.choice(1 << 20, 60, replace=False)
    sets = [np.sort(np.concatenate([shared, rng.integers(1 << 20, 1 << 40, 440)])).astype(np.uint64) for _ in range(30)]
    sets.append(np.delete(sets[0], [3, 200, 499]))
    sizes = [len(s) for s in sets]
    lengths = [trie.prefix_length(n, 80) for n in sizes]
    assert len(trie.pairs([s[:n] for s, n in zip(sets, lengths)], sizes, 80)) == len(sets) * (len(sets) - 1) // 2
    bits = [ngram_join.parities(s) for s in sets]
    assert ngram_join.may_link(bits, sizes, 80) == [(0, 30)] and all(len(b) * 8 < 8 * n for b, n in zip(bits, lengths))


def test_chance_company_is_not_looked_up(spark, monkeypatch):
    """Sets that share a rare passage but are far from linked: no whole set is asked for, but for the copies' own."""
    rnd = random.Random(6)
    passage = " ".join(f"rare{i}" for i in range(8))
    rows = [(i, passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60))) for i in range(50)]
    rows += [(100, rows[0][1] + " more")]
    asked, real = [], ngram_join._Corpus.whole
    monkeypatch.setattr(ngram_join._Corpus, "whole", lambda self, wanted: asked.append(wanted.distinct().count()) or real(self, wanted))
    compare(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert sum(asked) == 2


def test_trie_prunes_prefixes():
    rng = np.random.default_rng(0)
    base = np.sort(rng.choice(1 << 40, 500, replace=False)).astype(np.uint64)
    other = np.sort(np.concatenate([base[:5], rng.choice(1 << 40, 495, replace=False).astype(np.uint64)]))
    near = np.delete(base, [3, 200, 499])
    sets = [base, other, near]
    assert trie.pairs([s[: trie.prefix_length(len(s))] for s in sets], [len(s) for s in sets]) == [(0, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500)]
    top = {}

    def find(i):
        top.setdefault(i, i)
        while top[i] != i:
            i = top[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(i, find(i)) for i in list(top)} and len(got) == len(top)


def edited(rnd, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def sample():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(2000)]
    passage = " ".join(rnd.choices(vocab, k=60))
    rows = []
    for i in range(40):
        text = " ".join(rnd.choices(vocab, k=rnd.choice([4, 30, 80, 200])))
        rows.append(text)
        for edits in (0, 1, 2, 4, 8):
            if rnd.random() < 0.6:
                rows.append(edited(rnd, text, edits))
    base = " ".join(rnd.choices(vocab, k=150))
    for i in range(80):  # one large group of near copies, and some that link to only part of it
        rows.append(edited(rnd, base, rnd.choice([1, 1, 2, 5])))
    for _ in range(60):
        rows.append(" ".join(rnd.choices(vocab, k=8)) + " " + passage + " " + " ".join(rnd.choices(vocab, k=rnd.randrange(4, 9))))
    for size in range(1, 8):
        rows += [" ".join(vocab[:size]), " ".join(vocab[:size]).upper() + "\n"]
    rows += [None, "", "  ", "a a a a a a", "a a a", "a a"]
    out = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    out += [(None, "a a a"), (None, "alone null key"), (4, "same key twice"), (4, "same key twice"), (2, base)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [ngram_join.CHUNK_SETS, 6])
def test_components_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", chunk)
    rows = sample()
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, prefix string, n long").repartition(3)
    got = ngram_join.join(docs).collect()
    compare(got, rows)
    for component in {r.component_id for r in got if r.component_id is not None and r.n_shingles}:
        members = [r for r in got if r.component_id == component and r.n_shingles]
        assert sum(r.kept for r in members) == 1 and next(r for r in members if r.kept).doc_id == component


def test_other_sizes_and_shares(spark):
    rows = sample()
    compare(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), size=5, share=80).collect(), rows, 5, 80)


def test_second_round_finds_links_that_leads_miss(spark):
    """The least member of the group links to nothing; two others link to each other."""
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(5000)]
    shared = " ".join(rnd.choices(vocab, k=30))
    first = shared + " " + " ".join(rnd.choices(vocab, k=90))
    second = shared + " " + " ".join(rnd.choices(vocab, k=90))
    rows = [(1, first), (2, second), (3, edited(rnd, second, 1)), (4, edited(rnd, second, 1)), (5, " ".join(rnd.choices(vocab, k=120)))]
    compare(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet(DATA)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compare(ngram_join.join(docs).collect(), rows)


def test_one_row_of_each_component_stays(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "A b c d e f g  h"), (3, "x y z"), (3, "q r s"), (4, None), (5, None), (5, None)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [
        (1, "a b c d e f g h"), (3, "q r s"), (3, "x y z"), (4, ""), (5, ""), (5, ""),
    ]
    assert ngram_join.keep_one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [ngram_join.CHUNK_SETS, 6])
def test_all_links_and_their_counts(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", chunk)
    rows = [r for r in sample() if r[0] is not None]
    pairs, members = ngram_join.links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    sets = [(key, shingles(text)) for key, text in rows]
    counts = sorted((key, sum(link(s, t) for j, (_, t) in enumerate(sets) if j != i)) for i, (key, s) in enumerate(sets))
    assert sorted((r.doc_id, r.links) for r in members.collect()) == counts
    name = {}
    for key, s in sets:
        if s:
            name[frozenset(s)] = min(key, name.get(frozenset(s), key))
    classes = list(name)
    want = {tuple(sorted((name[a], name[b]))) for i, a in enumerate(classes) for b in classes[:i] if link(a, b)}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    assert {(r.doc_id, r.class_id) for r in members.collect()} == {(key, name[frozenset(s)] if s else None) for key, s in sets}
    pairs, members = ngram_join.links(spark.createDataFrame([], "doc_id long, text string"))
    assert pairs.count() == members.count() == 0


def test_a_large_group_of_unlinked_sets_is_joined_on_whole_sets(spark, monkeypatch):
    """All share the rare passage that their prefixes hold; few are linked, and prefixes cannot tell."""
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 20)
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    passage = " ".join(f"rare{i}" for i in range(30))
    rows = [(i, " ".join(rnd.choices(vocab, k=3)) + " " + passage + " " + " ".join(rnd.choices(vocab, k=rnd.randrange(3, 6)))) for i in range(120)]
    rows += [(1000 + i, edited(rnd, rows[i][1], 1)) for i in range(0, 120, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(ngram_join.join(docs, share=60).collect(), rows, 3, 60)
    compare(ngram_join.join(docs, share=90).collect(), rows, 3, 90)


def test_rare_and_common_tokens_make_the_same_groups(spark):
    rnd = random.Random(4)
    sets = [(i, n, sorted({rnd.randrange(60) * 7919 - 200_000 << 40 for _ in range(6)} | {-1, 5} if i % 2 else {i, -i - 2})) for i, n in ((i, rnd.choice([20, 21, 40])) for i in range(200))]
    prefixes = spark.createDataFrame(sets, "cls long, n long, tokens array<long>").repartition(4)
    found = [
        {tuple(r) for r in ngram_join._groups(prefixes, 90, light).select("x", "y", "cls", "n").collect()}
        for light in (0, 1 << 19, 1 << 20)
    ]
    assert found[0] and found[0] == found[1] == found[2]
    by_token = {}
    for cls, n, tokens in sets:
        for token in tokens:
            for band in (0, 1):
                key = token, int(np.floor(np.log(n) / (np.log(100 / 90) * 1.0001))) + band
                by_token.setdefault(key, set()).add(cls)
    want = {frozenset(g) for g in by_token.values() if len(g) > 1}
    groups = {}
    for x, y, cls, _ in found[0]:
        groups.setdefault((x, y), set()).add(cls)
    assert {frozenset(g) for g in groups.values()} == want and len(groups) == len(want)
