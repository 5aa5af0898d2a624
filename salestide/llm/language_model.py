"""A hidden Markov language model: Baum-Welch over partitions, exact forward scores.

Latent states emit words, and the end of a text. Expected emissions are a Spark table by word, which grows with
the vocabulary; blocks send their sums and get the rows of their own words. Emissions are smoothed towards the words'
shares, of which one is for words never seen, so the model is a distribution over all texts. Baum-Welch goes on until a
round gains less than ``TOLERANCE``; a round's table is removed with the round after it.

Texts are read once. Each input task cuts them into blocks, numbers the words of a block, and writes the
numbers and the block's vocabulary with counts. Word counts come from the vocabularies, and
go back to the blocks that have the word, never to all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salestide.llm.hmm_core import Hmm, expected_counts, log_likelihoods
from salestide.llm.text import WordIds, crc_remainder, slices, text_or_empty, words
from salestide.session import discard, materialize, owner, release, workspace

STATES = 8
# Baum-Welch ends with the first round that gains less than this, in nats for each training token.
TOLERANCE = 0.002
STAY = 0.995
NOISE = 0.5
# Emissions are smoothed with this share of a state's mean tokens, as a word may be seen once; moves and starts with one token.
WORD_PRIOR = 0.5
ADD = 0.1
FOLDS, HELD_OUT = 10, 0
# Text of a block (a vocabulary of its own), and tokens that one recursion works on.
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 32_768
_TOKENS_AT_ONCE = 600_000
_BLOCK_SHIFT = 24
# Words' ids are a shard and a place in it, as monotonically_increasing_id gives them.
_SHARD_SHIFT = 33
_PLACE = (1 << _SHARD_SHIFT) - 1
_PLAN = "block bigint, tag int, shard bigint, n bigint, places binary, numbers binary, c binary"
_REPLY = "block bigint, tag int, shard bigint, packed binary"
_ROUND_COLUMNS = ["block", "tag", "shard", "packed", "sums"]
_ROUND = f"{_REPLY}, sums binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Low and high halves of 32-bit numbers apart: common words have small numbers, so the high halves compress well."""
    halves = numbers.astype("<u4").view("<u2").reshape(-1, 2)
    return np.ascontiguousarray(halves.T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
    return high << 16 | low


def _planes(numbers: np.ndarray) -> bytes:
    """The bytes of numbers, lowest bytes of all first: those that are mostly zero compress well."""
    return np.ascontiguousarray(numbers.reshape(-1, 1).view(np.uint8).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind)[:, 0]


def _pack_rows(emitted: np.ndarray, whole: bool = False) -> bytes:
    """Words' expected emissions: each word's sum in single precision (``whole``: a whole number), and the states' shares of it in 16 bits.

    A share is off by at most 1/131070 of the word's sum, and the sums are not.
    """
    total = emitted.sum(axis=1)
    total = (np.rint(total) if whole else total).astype("<f4")
    shares = emitted / np.maximum(emitted.sum(axis=1, keepdims=True), 1e-30) * 65535
    return _planes(total) + _planes(np.rint(shares).astype("<u2").ravel())


def _unpack_rows(data: bytes, states: int) -> np.ndarray:
    n = len(data) // (4 + 2 * states)
    shares = _from_planes(data[4 * n :], "<u2").reshape(n, states).astype(np.float32)
    return shares * (_from_planes(data[: 4 * n], "<f4") / np.maximum(shares.sum(axis=1), 1))[:, None]


class _Block:
    """Texts whose words are numbered together."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.ids, self.bytes, self.rows = WordIds(), 0, 0
        self.counts: list[np.ndarray] = []

    def add(self, texts: list[str], training: list[bool]) -> list[bytes]:
        """Numbers of the words of some texts."""
        numbers = [np.array(list(map(self.ids.__getitem__, words(t))), np.int32) for t in texts]
        self.bytes += sum(map(len, texts))
        self.rows += len(texts)
        self.counts += [n for n, counted in zip(numbers, training) if counted]
        return [_packed(n) for n in numbers]

    def vocabulary(self) -> pa.RecordBatch:
        """The block's words with their training counts."""
        n = len(self.ids)
        counts = np.bincount(np.concatenate(self.counts), minlength=n) if self.counts else np.zeros(n, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, self.number)), pa.array(np.arange(n, dtype=np.int32)), pa.array(list(self.ids), pa.binary()),
                pa.array(counts.astype(np.int64)),
            ],
            ["block", "local", "word", "n"],
        )


def encode(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Encoded texts and blocks' vocabularies, both stored; the latter may be discarded first.

    Texts: ``block``, ``_key``, ``held_out``, ``numbers`` (see :func:`_packed`), without the end. Words: ``block``, ``local``
    (number), ``word``, ``n`` (training count).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), (~training).alias("held_out"), text_or_empty(text).alias("text"))
    key_kind, key_type = rows.schema["_key"].dataType.simpleString(), to_arrow_type(rows.schema["_key"].dataType)
    kinds = [
        ("kind", pa.string()), ("block", pa.int64()), ("_key", key_type), ("held_out", pa.bool_()), ("numbers", pa.binary()),
        ("local", pa.int32()), ("word", pa.binary()), ("n", pa.int64()),
    ]
    schema = pa.schema(kinds)

    def filled(kind: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        columns = [
            pa.array([kind] * n) if f.name == "kind"
            else batch.column(f.name) if f.name in batch.schema.names else pa.nulls(n, f.type) for f in schema
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _BLOCK_SHIFT
        block = _Block(base)
        for batch in slices(batches):
            training = [not held for held in batch.column("held_out").to_pylist()]
            numbers = block.add(batch.column("text").to_pylist(), training)
            yield filled("text", pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(numbers), block.number)), batch.column("_key"), batch.column("held_out"),
                 pa.array(numbers, pa.binary())],
                ["block", "_key", "held_out", "numbers"],
            ))
            if block.bytes >= BLOCK_BYTES or block.rows >= BLOCK_ROWS:
                yield filled("word", block.vocabulary())
                block = _Block(block.number + 1)
        yield filled("word", block.vocabulary())

    ddl = f"kind string, block bigint, _key {key_kind}, held_out boolean, numbers binary, local int, word binary, n bigint"
    path = workspace(spark, "encoded")
    rows.mapInArrow(run, ddl).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(ddl).parquet(path)
    return (
        stored.filter("kind = 'text'").select("block", "_key", "held_out", "numbers"),
        owner(stored.filter("kind = 'word'").select("block", "local", "word", "n"), f"{path}/kind=word"),
    )


class Counts:
    """What the training texts hold: tokens with ends, distinct ones, texts."""

    def __init__(self, words: int, types: int, texts: int) -> None:
        self.texts, self.tokens, self.vocabulary = texts, words + texts, types + (texts > 0)

    @property
    def base_total(self) -> float:
        return self.tokens + ADD * (self.vocabulary + 1)


def word_counts(vocabularies: DataFrame) -> DataFrame:
    """Training count (``c``) of each word that training texts have."""
    return vocabularies.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c"))


def total_counts(counts: DataFrame, texts: DataFrame) -> Counts:
    found = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("words"), F.count(F.lit(1)).alias("types")).first()
    return Counts(found["words"], found["types"], texts.filter("not held_out").count())


def _sequences(texts: list[bytes], end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of packed texts on end, each closed by the end, and their offsets; so many texts at once as one recursion takes.

    Texts keep their order; those of like length together are quickest.
    """
    ends = np.cumsum([len(t) // 4 + 1 for t in texts], dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + _TOKENS_AT_ONCE, side="right")))
        offsets = np.concatenate([[0], ends[start:stop] - before])
        symbols = np.full(offsets[-1], end, np.int64)
        for coded, a, b in zip(texts[start:stop], offsets[:-1], offsets[1:]):
            symbols[a : b - 1] = _unpacked(coded)
        yield symbols, offsets
        start = stop


def _converged(before: float | None, likelihood: float, tokens: int) -> bool:
    return before is not None and likelihood - before < TOLERANCE * tokens


class WordModel:
    """A model by words: starts, moves and sums on the driver, expected emissions in a table ``id``, ``e0``, ``e1``, ..."""

    def __init__(
        self, start: np.ndarray, move: np.ndarray, end: np.ndarray, emitted: DataFrame, counts: Counts, words: np.ndarray | None = None
    ) -> None:
        self.start, self.move, self.end, self.emitted = start, move, end, emitted
        #: The working table that ``emitted`` reads, if it has one of its own.
        self.table: DataFrame | None = None
        #: What blocks get of it, by the plan that the round had.
        self.replies: DataFrame | None = None
        self.base, self.texts = counts.base_total, counts.texts
        self.prior = WORD_PRIOR * max(counts.tokens, 1) / len(start)
        if words is None:
            words = np.array([x or 0.0 for x in emitted.agg(*[F.sum(e) for e in _emissions(len(start))]).first()])
        self.of_state = words + end

    def of_block(self, local: pd.DataFrame) -> Hmm:
        """The model over a block's words, by their numbers, and the end, numbered after the last. Numbers may be left out."""
        return self.of_words(local["local"].to_numpy(np.int64), local["c"].to_numpy(), local[_emissions(len(self.start))].to_numpy())

    def of_words(self, place: np.ndarray, found: np.ndarray, emitted: np.ndarray, kind: type = np.float64) -> Hmm:
        k = len(self.start)
        size = int(place.max()) + 2 if len(place) else 1
        c, e = np.zeros(size), np.zeros((size, k), kind)
        c[place], c[-1] = found, self.texts
        e[place], e[-1] = emitted, self.end
        unigram = (c + ADD) / self.base
        e /= unigram[:, None]
        e += self.prior
        e /= self.of_state + self.prior
        return Hmm(self.start, self.move, e.T, unigram)


def _emissions(states: int) -> list[str]:
    return [f"e{s}" for s in range(states)]


def initial_words(known: DataFrame, counts: Counts, states: int = STATES) -> WordModel:
    """Sticky states whose emissions differ a little, by a hash of word and state, from the words' shares."""
    def noise(s: int) -> Column:  # uniform, of variance 1
        return (F.pmod(F.xxhash64("word", F.lit(s)), F.lit(1 << 20)) / F.lit((1 << 19) / 3**0.5)) - F.lit(3**0.5)

    emitted = known.select("id", *[(F.col("c") * F.exp(NOISE * noise(s)) / states).alias(e) for s, e in enumerate(_emissions(states))])
    move = np.full((states, states), (1 - STAY) / max(states - 1, 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return WordModel(np.full(states, 1 / states), move, np.full(states, counts.texts / states), emitted, counts)


def plan_words(local: DataFrame) -> DataFrame:
    """What blocks ask for, stored: for each block and shard of words, the words' places in the shard, numbers in the block, and counts.

    ``local`` has blocks' words (``_block``, ``local``, ``id``, ``c``, and ``n`` if some may be in no training text of the block: these
    are apart, with ``tag`` 1), or is such a plan already. An ``id`` is its word's shard and place in it, as
    monotonically_increasing_id gives them. Words without an emission (negative ``id``) are in shard -1.
    """
    if "places" in local.columns:
        return local

    def pack(words: pd.DataFrame) -> pd.DataFrame:
        ids, n = words["id"].to_numpy(np.int64), words["n"].to_numpy(np.int64)
        order = np.lexsort([ids, n == 0])
        ids, n = ids[order], n[order]
        numbers, c = words["local"].to_numpy(np.int32)[order], words["c"].to_numpy(np.int64)[order]
        shards = np.where(ids < 0, -1, ids >> _SHARD_SHIFT)
        cuts = np.append(np.flatnonzero((np.diff(shards, prepend=-2) != 0) | (np.diff(n == 0, prepend=False) != 0)), len(ids))
        block, rows = words["_block"].iloc[0], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            places = np.diff(ids[a:b] & _PLACE, prepend=0) if shards[a] >= 0 else np.zeros(b - a, np.int64)
            packed = (_planes(x) for x in (places.astype("<i4"), numbers[a:b], c[a:b]))
            rows.append((block, int(n[a] == 0), shards[a], n[a:b].sum(), *packed))
        return pd.DataFrame(rows, columns=["block", "tag", "shard", "n", "places", "numbers", "c"])

    n = "n" if "n" in local.columns else F.lit(1).alias("n")
    return materialize(local.select("_block", "local", "id", "c", n).groupBy("_block").applyInPandas(pack, _PLAN), "plan")


def _places(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, "<i4"), dtype=np.int64)


def look_up(model: WordModel, plan: DataFrame) -> DataFrame:
    """Emissions of blocks' words, packed: a row for each row of the plan that names a shard."""
    k = len(model.start)
    names = _emissions(k)

    def reply(words: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        place = words["id"].to_numpy(np.int64) & _PLACE
        table = np.zeros((int(place.max()) + 1 if len(place) else 0, k), np.float32)
        table[place] = words[names].to_numpy(np.float32)
        packed = [_pack_rows(table[_places(p)]) for p in asked["places"]]
        return asked[["block", "tag", "shard"]].assign(packed=packed)

    rows = model.emitted.select(F.shiftright("id", _SHARD_SHIFT).alias("shard"), "id", *[F.col(e).cast("float").alias(e) for e in names])
    asked = plan.filter("shard >= 0").select("block", "tag", "shard", "places")
    return rows.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(reply, _REPLY)


def _for_blocks(plan: DataFrame, replies: DataFrame) -> DataFrame:
    """Both as rows of one table, to be grouped by block."""
    return plan.unionByName(replies, allowMissingColumns=True)


def _of_block(words: pd.DataFrame, states: int) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Of what :func:`_for_blocks` has for a block: shards asked (shard, places, words), and words' numbers, counts and emissions, in that order."""
    got = {(tag, shard): packed for tag, shard, packed in zip(words["tag"], words["shard"], words["packed"]) if packed is not None}
    asked, numbers, c, emitted = [], [np.zeros(0, "<i4")], [np.zeros(0, "<i8")], [np.zeros((0, states), np.float32)]
    for tag, shard, places, own, count, packed in words[["tag", "shard", "places", "numbers", "c", "packed"]].itertuples(index=False):
        if packed is not None:
            continue
        numbers.append(_from_planes(own, "<i4"))
        c.append(_from_planes(count, "<i8"))
        emitted.append(_unpack_rows(got[tag, shard], states) if shard >= 0 else np.zeros((len(c[-1]), states), np.float32))
        asked.append((shard, places, len(c[-1])))
    return asked, np.concatenate(numbers), np.concatenate(c), np.concatenate(emitted)


def improve_words(model: WordModel, texts: DataFrame, local: DataFrame, counts: Counts) -> tuple[WordModel, float]:
    """One Baum-Welch round over all training texts: the new model, and the old one's log-likelihood (as ratio to the unigrams).

    ``local`` has the words of each block's training texts at least, or is a plan of them. Blocks send
    each shard their sums of its words in one row, and get the new emissions of the same words so. Starts, moves, the end and the
    likelihood are summed as shard -1.
    """
    k = len(model.start)
    bare, plan = _bare(model), plan_words(local)

    def partial(rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        asked, numbers, c, emitted = _of_block(words, k)
        fast = bare.of_words(numbers, c, emitted, np.float32).cast(np.float32)
        del c, emitted
        end = len(fast.unigram) - 1
        starts, moves, emits, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((k, end + 1)), 0.0
        for symbols, offsets in _sequences(sorted(rows["numbers"], key=len), end):
            s, m, _, ll = expected_counts(fast, symbols, offsets, emits)
            starts, moves, likelihood = starts + s, moves + m, likelihood + ll
        block, done, out = words["block"].iloc[0] if len(words) else rows["block"].iloc[0], 0, []
        for shard, places, n in asked:
            if shard >= 0:
                out.append((shard, block, places, _pack_rows(emits[:, numbers[done : done + n]].T, whole=True)))
            done += n
        head = np.concatenate([starts, moves.ravel(), emits[:, end], [likelihood]])
        out.append((-1, block, b"", head.tobytes()))
        return pd.DataFrame(out, columns=["shard", "block", "places", "packed"])

    def add(sent: pd.DataFrame) -> pd.DataFrame:
        shard = sent["shard"].iloc[0]
        if shard < 0:
            head = np.sum([np.frombuffer(x) for x in sent["packed"]], axis=0)
            return pd.DataFrame([(None, 0, shard, None, head.tobytes())], columns=_ROUND_COLUMNS)
        places = [_places(p) for p in sent["places"]]
        total = np.zeros((max(int(p[-1]) for p in places) + 1, k), np.float64)
        for place, packed in zip(places, sent["packed"]):
            total[place] += _unpack_rows(packed, k)
        rows = [(b, 0, shard, _pack_rows(total[place]), None) for b, place in zip(sent["block"], places)]
        rows.append((None, 0, shard, _pack_rows(total), total.sum(axis=0).tobytes()))
        return pd.DataFrame(rows, columns=_ROUND_COLUMNS)

    replies = look_up(model, plan) if model.replies is None else model.replies
    sent = texts.filter("not held_out").select("block", "numbers").groupBy("block").cogroup(
        _for_blocks(plan, replies).groupBy("block")
    ).applyInPandas(partial, "shard bigint, block bigint, places binary, packed binary")
    stored = materialize(sent.groupBy("shard").applyInPandas(add, _ROUND), "round")
    sums = stored.filter("sums is not null").select("shard", "sums").collect()
    head = next(np.frombuffer(bytes(r.sums)) for r in sums if r.shard < 0)
    words = np.sum([np.zeros(k), *[np.frombuffer(bytes(r.sums)) for r in sums if r.shard >= 0]], axis=0)
    starts, moves = head[:k] + 1, head[k : k + k * k].reshape(k, k) + 1
    own = stored.filter("block is null and shard >= 0").select("shard", "packed")
    new = WordModel(
        starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), head[k + k * k : -1].copy(), _as_rows(own, k), counts, words
    )
    new.table, new.replies = stored, stored.filter("block is not null").select("block", "tag", "shard", "packed")
    return new, float(head[-1])


def _as_rows(own: DataFrame, states: int) -> DataFrame:
    """Packed emissions of shards as a row for each word that has any."""
    names = _emissions(states)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, packed in zip(batch.column("shard").to_pylist(), batch.column("packed")):
                rows = _unpack_rows(packed.as_buffer(), states)
                used = np.flatnonzero(rows.any(axis=1))
                ids = pa.array(used + (shard << _SHARD_SHIFT))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(rows[used, s]) for s in range(states)]], ["id", *names])

    return own.mapInArrow(run, "id bigint, " + ", ".join(f"{e} float" for e in names))


def _bare(model: WordModel) -> WordModel:
    """The model without its tables, for tasks."""
    bare = object.__new__(WordModel)
    bare.__dict__.update({name: value for name, value in vars(model).items() if name not in ("emitted", "table", "replies")})
    return bare


def train_words(
    texts: DataFrame, known: DataFrame, local: DataFrame, counts: Counts, states: int = STATES, rounds: int | None = None
) -> WordModel:
    """The model after so many rounds, or until it has converged. Two rounds' tables are there at most."""
    model, before, done, plan = initial_words(known, counts, states), None, 0, plan_words(local)
    while counts.texts and done != rounds:
        better, likelihood = improve_words(model, texts, plan, counts)
        ended = rounds is None and _converged(before, likelihood, counts.tokens)
        model, old = (model, better) if ended else (better, model)
        if old.table is not None:
            discard(old.table)
        del old, better
        release(texts.sparkSession)
        if ended:
            break
        before, done = likelihood, done + 1
    if model.table is not None:
        packed, model.replies = model.table, None
        model.emitted = model.table = materialize(model.emitted, "emissions")
        discard(packed)
    return model


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", states: int = STATES, rounds: int | None = None) -> DataFrame:
    """One row per document: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Trained on the documents whose crc32(key as text) modulo ``FOLDS`` is not 0 (a null key counts as empty), for
    ``rounds`` or until it has converged. Null and empty texts are one end token. ``base_score`` is the smoothed
    unigram log10 probability, ``score`` the model's. Rows that repeat a key are scored, and counted in training, each.
    With no training rows every word is unseen. No rows give no rows; other columns are not read.
    """
    texts, vocabularies = encode(docs, crc_remainder(key, FOLDS) != HELD_OUT, key, text)
    known = materialize(word_counts(vocabularies).withColumn("id", F.monotonically_increasing_id()), "word-counts")
    counts = total_counts(known, texts)
    unseen = -1 - F.pmod(F.xxhash64("word"), F.lit(1 << 40))  # words that no training text has; spread, as they are many
    # Every block gets the counts of its own words; frequent words are skewed keys, with a row per block at most.
    local = vocabularies.select("block", "local", "word", "n").join(known.select("word", "id", "c"), "word", "left").select(
        F.col("block").alias("_block"), "local", F.coalesce("id", unseen).alias("id"), F.coalesce("c", F.lit(0)).alias("c"), "n"
    )
    release(docs.sparkSession)  # what was shuffled so far, here and below, before more is
    local = materialize(local, "block-words")
    discard(vocabularies)
    release(docs.sparkSession)
    plan = plan_words(local)
    discard(local)
    release(docs.sparkSession)
    # Rounds need no words that a block's training texts don't have.
    model = train_words(texts, known, plan.filter("tag = 0"), counts, states, rounds)
    finish = _finish_words(model)
    key_kind = texts.schema["_key"].dataType.simpleString()
    finished = texts.select("block", "_key", "held_out", "numbers").groupBy("block").cogroup(
        _for_blocks(plan, look_up(model, plan)).groupBy("block")
    ).applyInPandas(finish, f"_key {key_kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return finished.select(
        F.col("_key").alias(key), "held_out", "n_tokens", "n_known", F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )


def _finish_words(model: WordModel) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    bare, trained = _bare(model), model.texts > 0

    def finish(texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        texts = texts.iloc[np.argsort(texts["numbers"].str.len(), kind="stable")]
        _, numbers, c, emitted = _of_block(words, len(bare.start))
        own, end = bare.of_words(numbers, c, emitted), len(numbers)
        logs, known = np.log10(own.unigram), np.zeros(end + 1, np.int64)
        known[numbers], known[end] = c > 0, trained
        parts = []
        for symbols, offsets in _sequences(texts["numbers"].tolist(), end):
            sums = [np.add.reduceat(x[symbols], offsets[:-1]) for x in (known, logs)]
            parts.append(np.vstack([np.diff(offsets), *sums, log_likelihoods(own, symbols, offsets) / np.log(10)]))
        found = pd.DataFrame(np.hstack(parts).T, columns=["n_tokens", "n_known", "base_score", "score"])
        found = found.astype({"n_tokens": np.int64, "n_known": np.int64})
        return pd.concat([texts[["_key", "held_out"]].reset_index(drop=True), found], axis=1)

    return finish
