"""Small helpers on texts, shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.sieve import free_name, split
from salestide.session import fits_broadcast, materialize, release, scratch, small_broadcasts

# Rows of an Arrow batch that are worked on at once: bounded by count and by bytes of text.
SLICE_ROWS = 2048
SLICE_BYTES = 1 << 20
# Rows to be dropped are looked up by a broadcast up to this many, by bits of their hashes beyond.
MAX_BROADCAST_GONE = 50_000


def text_or_empty(column: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def keep_one(docs: DataFrame, decided: Callable[[], DataFrame], key: str, mark: str, of_row: Column) -> DataFrame:
    """``docs`` without the rows that ``decided()`` (key, mark, ``kept``) drops; all columns stay as they are.

    ``of_row`` computes a row's mark. Rows that repeat both the key and the mark of a kept row cannot be told
    apart from it; one of them stays. Of the working tables, only the marks of dropped rows outlive the call.
    """
    with scratch(docs.sparkSession) as keep, small_broadcasts(docs.sparkSession):
        return _keep_one(docs, decided(), key, mark, of_row, keep)


def _keep_one(
    docs: DataFrame, decided: DataFrame, key: str, mark: str, of_row: Column, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    stored = materialize(decided.select(F.col(key).alias("_k"), F.col(mark).alias("_m"), "kept"), "decided")
    gone = keep(materialize(stored.filter("not kept").select("_k", "_m").distinct(), "gone"))
    kept = stored.filter("kept").select("_k", "_m").distinct()
    tied = keep(materialize(gone.join(kept, gone["_k"].eqNullSafe(kept["_k"]) & (gone["_m"] == kept["_m"]), "left_semi"), "tied"))
    release(docs.sparkSession)
    # Few rows go as a rule: the others stay where they are.
    if fits_broadcast(gone, MAX_BROADCAST_GONE):
        whole = docs.join(F.broadcast(gone), docs[key].eqNullSafe(gone["_k"]) & (of_row == gone["_m"]), "left_anti")
    else:
        maybe, others = split(docs, gone, [docs[key], of_row], [gone["_k"], gone["_m"]])
        whole = maybe.join(gone.hint("merge"), maybe[key].eqNullSafe(gone["_k"]) & (of_row == gone["_m"]), "left_anti").union(others)
    if tied.isEmpty():
        return whole
    column = free_name(docs, "_mark_of_text")
    again = docs.withColumn(column, of_row)
    again = again.join(tied, again[key].eqNullSafe(tied["_k"]) & (again[column] == tied["_m"]), "left_semi")
    return whole.unionByName(again.dropDuplicates([key, column]).drop(column))


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo ``modulus``; a null key counts as the empty text."""
    written = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.crc32(written) % F.lit(modulus)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no piece holds more than ``SLICE_BYTES`` of text, single rows aside."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = min(max(stop, start + 1), start + SLICE_ROWS)
            yield batch.slice(start, stop - start)
            start = stop


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, in UTF-8; other letters keep their case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordIds(dict):
    """Numbers words in order of first sight: ``ids[word]`` gives a new number to a new word."""

    def __init__(self) -> None:
        super().__init__()
        self._next = count().__next__

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self._next()
        return number


def word_hashes(token_lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word of all lists on end, and the offsets of the lists; each distinct word is hashed once."""
    ids = WordIds()
    offsets = np.zeros(len(token_lists) + 1, np.int64)
    np.cumsum([len(tokens) for tokens in token_lists], out=offsets[1:])
    numbers = np.empty(offsets[-1], np.int64)
    for i, tokens in enumerate(token_lists):
        numbers[offsets[i] : offsets[i + 1]] = list(map(ids.__getitem__, tokens))
    table = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in ids), np.uint64, len(ids))
    return (table[numbers] if len(ids) else np.zeros(0, np.uint64)), offsets


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finaliser of splitmix64)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; with fewer words, one hash of the whole sequence."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    width = len(hashes) - size + 1
    out = np.full(width, size, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[k : k + width]
    return mix64(out)
