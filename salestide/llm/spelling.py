"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the form each is a variant of.

All words stand in two tries, one of the words and one of the reversed words, whose nodes are numbered. A word gives a
pair (prefix node, suffix node) for each position that is skipped, and one for each gap between two positions. Words that
meet in the pair of a skipped position differ by a replacement there; a word whose gap meets another's skipped position
lacks that code point. Both joins are one grouping by pair of integers, and exact. Words of one pair of skipped positions
differ in a single code point, so a group has no more of them than there are letters; a gap's pair spells one word.

Rules: null text has no words, a null key is written as the empty string; a word counts as often as it stands in the
texts; runs of any length are taken whole (their pairs are two integers a position). No words give an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm import trie_nodes
from salestide.session import materialize

#: Distinct words that a task counts before it hands on what it has.
COUNTED_AT_ONCE = 1 << 18
MAX_ROUNDS = 40
_GAP, _SKIP, _SKIP_INSIDE_RUN = 0, 1, 2
_PAIRS = "f bigint, r bigint, n bigint, word bigint, kind tinyint"
_NEAR = "word bigint, n_near bigint, best_n bigint, best bigint"
#: A-Z, a-z and U+00C0 to U+00FF in Latin-1, the first lower-cased; all else parts words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """Runs of letters, A-Z lower-cased, in Latin-1: every other code point becomes a byte that is no letter."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _cut(key: bytes, run: bytes, every: int) -> bytes:
    written = run if run.isascii() else run.decode("latin-1").encode("utf-8")
    drawn = zlib.crc32(written, zlib.crc32(key))
    if drawn % every:
        return run
    at = drawn % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, drop_every: int | None = 31) -> DataFrame:
    """``word, n`` of the letter runs of all texts with at least ``shortest`` code points.

    With ``drop_every``, runs whose crc32 of ``key:run`` it divides lose a code point: misspellings that are known.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in found], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                here = Counter(run for run in runs(whole.as_py()) if len(run) >= shortest)
                if drop_every:
                    name = f"{name or ''}:".encode()
                    for run, n in here.items():
                        word = _cut(name, run, drop_every)
                        if len(word) >= shortest:
                            found[word] += n
                else:
                    found.update(here)
                if len(found) >= COUNTED_AT_ONCE:
                    yield counted()
                    found.clear()
        if found:
            yield counted()

    texts = docs.filter(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(sew_prefix, sew_suffix):
    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # Few words at once: a long one has as many pairs as letters.
            sizes = np.diff(batch.column("prefixes").offsets.to_numpy())
            ends, start = np.cumsum(sizes), 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + (1 << 17), side="right")))
                yield _of_slice(batch.slice(start, stop - start), sew_prefix, sew_suffix)
                start = stop

    return pairs


def _of_slice(batch: pa.RecordBatch, sew_prefix, sew_suffix) -> pa.RecordBatch:
    spelled = batch.column("spelled").to_pylist()
    lengths = np.array([len(word) for word in spelled], np.int64)
    letters = np.frombuffer("".join(spelled).encode("utf-32-le"), np.uint32)
    prefixes, suffixes = sew_prefix(batch.column("prefixes").flatten().to_numpy()), sew_suffix(batch.column("suffixes").flatten().to_numpy())
    words, counts = batch.column("word").to_numpy(), batch.column("n").to_numpy()
    # Prefix nodes of a word stand at its first node, then by length; suffix nodes too.
    nodes = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    begun = np.concatenate([[0], np.cumsum(lengths)])[:-1]

    def each(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of = np.repeat(np.arange(len(sizes)), sizes)
        return of, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)

    of_skip, skip = each(lengths)
    of_gap, gap = each(lengths + 1)
    before = np.concatenate([letters[:1] + 1, letters[:-1]])
    inside = (skip > 0) & (letters[begun[of_skip] + skip] == before[begun[of_skip] + skip])
    f = np.concatenate([prefixes[nodes[of_skip] + skip], prefixes[nodes[of_gap] + gap]])
    r = np.concatenate([suffixes[nodes[of_skip] + lengths[of_skip] - 1 - skip], suffixes[nodes[of_gap] + lengths[of_gap] - gap]])
    of = np.concatenate([of_skip, of_gap])
    kind = np.concatenate([np.where(inside, _SKIP_INSIDE_RUN, _SKIP), np.full(len(gap), _GAP)]).astype(np.int8)
    return pa.RecordBatch.from_arrays(
        [pa.array(f), pa.array(r), pa.array(counts[of]), pa.array(words[of]), pa.array(kind)], ["f", "r", "n", "word", "kind"]
    )


def _meet(f: np.ndarray, r: np.ndarray, n: np.ndarray, word: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
    """Near words by group (f, r), whose rows stand together by falling n, then word: count and best of each row."""
    same = (f[1:] == f[:-1]) & (r[1:] == r[:-1])
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    group = np.concatenate([[0], np.cumsum(~same)])[shared]
    n, word, kind = n[shared], word[shared], kind[shared]
    if not len(n):
        return [np.zeros(0, np.int64)] * 4
    group -= group[0]
    group = np.unique(group, return_inverse=True)[1]
    groups = group[-1] + 1
    none = len(n)  # a row that is no row
    n, word = np.append(n, -1), np.append(word, 0)

    def first_two(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each group: how many rows are chosen, the first and the second of them."""
        size = np.bincount(group[chosen], minlength=groups)
        at = np.append(np.flatnonzero(chosen), [none, none])
        begin = np.cumsum(size) - size
        return size, np.where(size > 0, at[begin], none), np.where(size > 1, at[np.minimum(begin + 1, len(at) - 1)], none)

    skips, top, second = first_two(kind != _GAP)
    once, longer, _ = first_two(kind == _SKIP)
    _, spelled, _ = first_two(kind == _GAP)
    row = np.arange(none)
    replaced = np.where(row == top[group], second[group], top[group])
    shorter = np.where(kind == _SKIP, spelled[group], none)
    # A skipped position meets the other skipped ones and the word that has the gap; the gap meets the longer words.
    count = np.where(kind == _GAP, once[group], skips[group] - 1 + (shorter < none))
    better = (n[shorter] > n[replaced]) | ((n[shorter] == n[replaced]) & (word[shorter] < word[replaced]))
    best = np.where(kind == _GAP, longer[group], np.where(better, shorter, replaced))
    met = count > 0
    return [word[:none][met], count[met], n[best[met]], word[best[met]]]


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pairs in, near words by group out; the last group of a batch waits for the next batch."""
    names = ["f", "r", "n", "word", "kind"]
    waiting = [np.zeros(0, np.int64)] * 5
    for batch in batches:
        columns = [np.concatenate([w, batch.column(name).to_numpy()]) for w, name in zip(waiting, names)]
        f, r = columns[:2]
        if not len(f):
            continue
        cut = len(f) - 1
        while cut and f[cut - 1] == f[-1] and r[cut - 1] == r[-1]:
            cut -= 1
        waiting = [c[cut:] for c in columns]
        if cut:
            yield _near_batch([c[:cut] for c in columns])
    if len(waiting[0]):
        yield _near_batch(waiting)


def _near_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    found = _meet(*columns)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["word", "n_near", "best_n", "best"])


def near(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered words, and of each word with near words their number and the best: (word, spelled, n), (word, n_near, best_n, best).

    ``words``: word, n, distinct. Numbers follow the code-point order of the words. The best has the largest n, then the
    smallest number.
    """
    forward, sew_prefix = trie_nodes.number(words.select(F.col("word").alias("key"), F.col("n").alias("carry")), "words")
    forward = forward.select(F.col("place").alias("word"), F.col("key").alias("spelled"), F.col("carry").alias("n"), F.col("nodes").alias("prefixes"))
    backward, sew_suffix = trie_nodes.number(forward.select(F.reverse("spelled").alias("key"), F.col("word").alias("carry")), "reversed")
    both = forward.join(backward.select(F.col("carry").alias("word"), F.col("nodes").alias("suffixes")), "word")
    pairs = both.select("word", "spelled", "n", "prefixes", "suffixes").mapInArrow(_pairs(sew_prefix, sew_suffix), _PAIRS)
    met = pairs.repartition("f", "r").sortWithinPartitions("f", "r", F.desc("n"), "word").mapInArrow(_neighbours, _NEAR)
    best = F.max(F.struct("best_n", (-F.col("best")).alias("minus"))).alias("best")
    found = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    found = found.select("word", "n_near", "best.best_n", (-F.col("best.minus")).alias("best"))
    return forward.select("word", "spelled", "n"), found


def _roots(links: DataFrame) -> DataFrame:
    """``word, form, root``: each link followed to the last, the way halved in each round. ``links``: word, form."""
    now = materialize(links.select("word", "form", F.col("form").alias("root")), "links")
    for turn in range(MAX_ROUNDS):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(onward, "root", "left")
        if moved.filter("further is not null").isEmpty():
            return now
        now = materialize(moved.select("word", "form", F.coalesce("further", "root").alias("root")), f"links-{turn}")
    raise RuntimeError("forms did not settle")


def variants(words: DataFrame, share: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``words`` (word, n; distinct).

    A word's form is its near word of largest n (of equal ones the first in code-point order), if that is at least
    ``share`` times the word's own; else null. Roots follow the forms to the last.
    """
    numbered, found = near(words)
    judged = materialize(
        numbered.join(found, "word", "left").withColumn("form", F.when(F.col("best_n") >= share * F.col("n"), F.col("best"))), "judged"
    )
    names = judged.select("word", "spelled")
    links = _roots(judged.filter("form is not null").select("word", "form"))
    named = links.join(names.toDF("form", "form_spelled"), "form").join(names.toDF("root", "root_spelled"), "root")
    whole = judged.drop("form").join(named.select("word", "form_spelled", "root_spelled"), "word", "left")
    return whole.select(
        F.col("spelled").alias("word"), F.col("form_spelled").alias("form"), F.coalesce("root_spelled", "spelled").alias("root"),
        "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("form_spelled").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def variants_of(docs: DataFrame, least: int = 2) -> DataFrame:
    """Variants of the words of ``docs`` (doc_id, text) that stand there at least ``least`` times."""
    return variants(count_words(docs).filter(F.col("n") >= least))
