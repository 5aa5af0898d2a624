import itertools
import os
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from salestide.llm import hmm_core, language_model

DATA = "/root/testdata/sf0.001/documents.parquet"


def small_model(k=3, symbols=5, seed=2):
    rng = np.random.default_rng(seed)
    unigram = rng.dirichlet(np.ones(symbols))
    return hmm_core.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(symbols), k) / unigram, unigram)


def paths(model, seq):
    emit = model.ratio * model.unigram
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * emit[path[0], seq[0]]
        for t in range(1, len(seq)):
            p *= model.move[path[t - 1], path[t]] * emit[path[t], seq[t]]
        yield path, p


def plain_forward(model, seq):
    emit = model.ratio * model.unigram
    state, total = model.start * emit[:, seq[0]], 0.0
    for t in range(len(seq)):
        if t:
            state = (state @ model.move) * emit[:, seq[t]]
        total += np.log(state.sum())
        state = state / state.sum()
    return total


def joined(seqs):
    return np.concatenate(seqs), np.cumsum([0] + [len(s) for s in seqs])


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_recursions_equal_sums_over_all_paths(monkeypatch, segment):
    monkeypatch.setattr(hmm_core, "SEGMENT", segment)
    model, rng = small_model(), np.random.default_rng(0)
    seqs = [rng.integers(0, 5, n) for n in (1, 2, 7, 3, 6, 1, 5)]
    starts, moves, emits, total = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5)), 0.0
    logs = []
    for seq in seqs:
        every = list(paths(model, seq))
        p = sum(x for _, x in every)
        logs.append(np.log(p))
        for path, x in every:
            starts[path[0]] += x / p
            for t, s in enumerate(path):
                emits[s, seq[t]] += x / p
                if t:
                    moves[path[t - 1], s] += x / p
    symbols, offsets = joined(seqs)
    assert np.allclose(hmm_core.log_likelihoods(model, symbols, offsets), logs)
    got = hmm_core.expected_counts(model, symbols, offsets)
    for mine, hand in zip(got, (starts, moves, emits)):
        assert np.allclose(mine, hand)
    assert np.isclose(got[3], sum(logs) - np.log(model.unigram)[symbols].sum())


def test_long_sequences_and_single_precision():
    model, rng = small_model(4, 50), np.random.default_rng(1)
    seqs = [rng.integers(0, 50, n) for n in (3000, 64, 65, 1, 700)]
    symbols, offsets = joined(seqs)
    want = [plain_forward(model, s) for s in seqs]
    assert np.allclose(hmm_core.log_likelihoods(model, symbols, offsets), want, rtol=1e-10)
    exact, fast = hmm_core.expected_counts(model, symbols, offsets), hmm_core.expected_counts(model.cast(np.float32), symbols, offsets)
    for a, b in zip(exact[:3], fast[:3]):
        assert np.allclose(a, b, rtol=1e-2, atol=1e-2)


def base_by_hand(rows):
    training = [(t or "").encode().lower().split() for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
    counts = Counter(w for ws in training for w in ws)
    texts = len(training)
    total, kinds = sum(counts.values()) + texts, len(counts) + (texts > 0)
    out = []
    for i, t in rows:
        own = (t or "").encode().lower().split()
        n = len(own) + 1
        known = sum(w in counts for w in own) + (texts > 0)
        score = sum(log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own) + log10((texts + 0.1) / (total + 0.1 * (kinds + 1)))
        out.append((i, n, known, total, score))
    return out


def compare(got, rows):
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr)
    hand = sorted(((i, n, k, t, round(s, 6)) for i, n, k, t, s in base_by_hand(rows)), key=repr)
    assert len(mine) == len(hand)
    for a, b in zip(mine, hand):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-4


@pytest.mark.parametrize("rows_a_block", [language_model.BLOCK_ROWS, 7])
def test_base_scores_equal_brute_force(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(language_model, "BLOCK_ROWS", rows_a_block)
    docs = spark.read.parquet(DATA)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = language_model.score(docs.repartition(3)).collect()
    compare(got, rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert np.mean([(r.score - r.base_score) / r.n_tokens for r in held]) > 0.02


def trained_by_words(docs, states, rounds):
    texts, vocabularies = language_model.encode(docs, language_model.crc_remainder("doc_id", 10) != 0)
    known = language_model.materialize(language_model.word_counts(vocabularies).selectExpr("*", "monotonically_increasing_id() id"), "known")
    counts = language_model.total_counts(known, texts)
    local = vocabularies.join(known.select("word", "id", "c"), "word", "left").selectExpr("block _block", "local", "ifnull(id, -1) id", "ifnull(c, 0) c")
    return language_model.train_words(texts, known, local, counts, states, rounds), known, texts, local, counts


def test_scores_by_words_are_forward_probabilities(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_ROWS", 7)
    docs = spark.read.parquet(DATA).filter("doc_id < 40")
    model, known, *_ = trained_by_words(docs, 3, 2)
    words = known.join(model.emitted, "id").toPandas()
    words["local"] = range(len(words))
    place = {bytes(w): n for n, w in enumerate(words["word"])}
    unseen = {"local": len(words), "c": 0, "e0": 0.0, "e1": 0.0, "e2": 0.0}
    whole = model.of_block(language_model.pd.concat([words, language_model.pd.DataFrame([unseen])]))
    assert np.isclose(whole.unigram.sum(), 1) and np.allclose((whole.ratio * whole.unigram).sum(1), 1, rtol=1e-4)
    score = {r.doc_id: r.score for r in language_model.score(docs, states=3, rounds=2).collect()}
    for r in docs.collect():
        symbols = [place.get(bytes(w), len(words)) for w in language_model.words(r.text)] + [len(words) + 1]
        want = plain_forward(whole, symbols) / np.log(10)
        assert abs(score[r.doc_id] - want) < 1e-3 * max(1, abs(want)) ** 0.5


def test_training_goes_on_until_it_has_converged(spark):
    model, known, texts, local, counts = trained_by_words(spark.read.parquet(DATA), 4, None)
    better, last = language_model.improve_words(model, texts, local, counts)
    _, after = language_model.improve_words(better, texts, local, counts)
    assert after - last < language_model.TOLERANCE * counts.tokens


def test_states_tell_topics_apart(spark):
    """Two topics of 200 words each, among many other words."""
    rng = np.random.default_rng(5)
    pairs = [(f"w{i}", f"v{i}") for i in range(200)]
    rows = [(i, " ".join(pairs[j][i % 2] for j in rng.integers(0, 200, 60))) for i in range(600)]
    rows += [(i, " ".join(f"x{i}-{j}" for j in range(200))) for i in range(600, 720)]
    got = language_model.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert np.mean([(r.score - r.base_score) / r.n_tokens for r in held]) > 0.25


def test_rounds_raise_the_likelihood(spark):
    docs = spark.read.parquet(DATA)
    model, known, texts, local, counts = trained_by_words(docs, 4, 0)
    seen = []
    for _ in range(4):
        model, likelihood = language_model.improve_words(model, texts, local, counts)
        seen.append(likelihood)
    assert seen == sorted(seen) and seen[-1] > seen[0] and np.isclose(model.move.sum(1), 1).all()


def test_a_rounds_table_ends_with_the_next(spark):
    def tables(model):
        folder = model.table.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        return {name for name in os.listdir(folder) if name.startswith("emissions-")}

    before = tables(trained_by_words(spark.read.parquet(DATA), 3, 1)[0])
    assert len(tables(trained_by_words(spark.read.parquet(DATA), 3, 3)[0]) - before) == 1


def test_working_tables_are_small(spark, monkeypatch):
    """Emissions are kept in single precision, the likelihood is not; blocks' vocabularies go once their words are looked up."""
    model, known, texts, local, counts = trained_by_words(spark.read.parquet(DATA), 3, 1)
    kinds = dict(model.table.dtypes)
    assert {kinds[f"e{s}"] for s in range(3)} == {"float"}
    assert model.emitted.columns == ["id", "e0", "e1", "e2"]
    total = sum(model.emitted.agg(*[language_model.F.sum(f"e{s}") for s in range(3)]).first()) + model.end.sum()
    assert np.isclose(total, counts.tokens, rtol=1e-5)
    made, train = [], language_model.train_words
    monkeypatch.setattr(language_model, "encode", lambda *a, encode=language_model.encode: made.append(encode(*a)) or made[-1])
    seen = []
    monkeypatch.setattr(language_model, "train_words", lambda t, k, words, *a: seen.append(words.filter("n = 0").count()) or train(t, k, words, *a))
    score = language_model.score(spark.read.parquet(DATA), states=2, rounds=1)
    folder = made[0][0].inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert [name for name in os.listdir(folder) if name.startswith("kind=")] == ["kind=text"]
    assert seen == [0] and score.count() == made[0][0].count()


def test_numbers_that_are_left_out_change_nothing():
    """A block's model over some of its words has the same columns for them and the end."""
    model = object.__new__(language_model.WordModel)
    model.__dict__.update(start=np.ones(2) / 2, move=np.ones((2, 2)) / 2, end=np.ones(2), base=20.0, texts=2, prior=0.5, of_state=np.array([9.0, 7.0]))
    words = language_model.pd.DataFrame({"local": [0, 1, 2, 4], "c": [3, 1, 0, 2], "e0": [2.0, 0.5, 0, 1], "e1": [1.0, 0.5, 0, 1]})
    some, whole = model.of_block(words[words["c"] > 0]), model.of_block(words)
    assert some.ratio.shape == whole.ratio.shape == (2, 6) and len(model.of_block(words[:0]).unigram) == 1
    assert np.array_equal(some.ratio, whole.ratio) and np.isclose(some.unigram[5], 2.1 / 20)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (5, "x " * 50_000), (6, "a b"), (6, "a b"), (10, "É é A a")]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, word string")
    got = language_model.score(docs).collect()
    compare(got, rows)
    assert all(r.score < 0 for r in got)
    assert language_model.score(docs.limit(0)).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    only = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    compare(language_model.score(only).collect(), [(i, "a b") for i in held])


def test_packed_emissions_keep_sums_and_shares():
    rng = np.random.default_rng(3)
    emitted = rng.dirichlet(np.full(5, 0.3), 300) * rng.integers(0, 9, 300)[:, None] * 10.0 ** rng.integers(0, 6, 300)[:, None]
    for whole in (False, True):
        packed = language_model._pack_rows(emitted, whole)
        got = language_model._unpack_rows(packed, 5)
        assert len(packed) == 300 * (4 + 2 * 5) and np.allclose(got.sum(1), emitted.sum(1), rtol=1e-6)
        assert (np.abs(got - emitted) <= emitted.sum(1, keepdims=True) * 2e-5).all()
    assert language_model._unpack_rows(language_model._pack_rows(emitted[:0]), 5).shape == (0, 5)


def test_rounds_send_packed_rows(spark):
    """A round's table has a row for each block and shard, not one for each word."""
    model, known, texts, local, counts = trained_by_words(spark.read.parquet(DATA).repartition(6), 3, 0)
    better, _ = language_model.improve_words(model, texts, local, counts)
    blocks, shards = local.select("_block").distinct().count(), known.selectExpr("shiftright(id, 33)").distinct().count()
    assert blocks > 5 and better.table.count() <= (blocks + 1) * shards + 1 < known.count() / 10
    want = {r.id: r for r in better.emitted.collect()}
    assert len(want) == known.count()
    for r in language_model.look_up(better, language_model.plan_words(local)).limit(3).collect():
        assert np.isfinite(language_model._unpack_rows(r.packed, 3)).all()
