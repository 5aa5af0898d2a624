"""Benchmark passages in documents, by SimHash over windows of each item's size.

A benchmark is a stated query set; it is taken in blocks of bounded size, and each block meets all documents
in one pass without a shuffle. A window has as many words as the item. Its fingerprint is the SimHash of its
shingles, got from running sums, and is compared with items of that size through a multi-index: fingerprints
are cut into blocks, and two within ``RADIUS`` bits must in one block differ by at most the radius over the
number of blocks, so a look-up of every block finds them all. Pairs within the radius are verified by the
exact similarity of their weighted shingles (each weighs as often as it occurs): sum of the lesser over sum
of the greater weights, at least ``SIMILARITY``.

Windows that share no shingle with any item have similarity 0 and are passed over before fingerprinting;
that loses none, since a verified pair shares most of its shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salestide.llm.text import mix64, shingle_hashes, slices, text_or_empty, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
# At similarity 0.8 about 10 of 64 bits differ, with a deviation of 3; twice that is allowed.
RADIUS = 20
BLOCKS = 8
# A block of the benchmark: what every executor holds at once.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 8 << 20
_WINDOWS_AT_ONCE = 8192
_FILTER_BITS = 20


def bits_of(shingles: np.ndarray) -> np.ndarray:
    """One row of 64 numbers, 1 or -1, for each shingle."""
    bits = np.unpackbits(mix64(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(bits: np.ndarray, width: int) -> np.ndarray:
    """SimHash (8 bytes a row) of every run of ``width`` shingles: the majority of each bit, ties as 1."""
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(sums[width:] - sums[:-width] >= 0, axis=1)


class SizeIndex:
    """Items of one number of words, and their fingerprints' blocks."""

    def __init__(self, size: int, items: list[int], shingles: list[np.ndarray], radius: int) -> None:
        self.size, self.items, self.radius = size, np.array(items), radius
        self.width = max(size - SHINGLE + 1, 1)
        self.prints = np.vstack([fingerprints(bits_of(s), len(s)) for s in shingles])
        values = np.arange(256, dtype=np.uint8)[:, None]
        near = radius // BLOCKS
        #: near[b][v]: the items whose block b differs from v by few enough bits.
        self.near = [np.bitwise_count(values ^ self.prints[None, :, b]) <= near for b in range(BLOCKS)]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs whose fingerprints are within the radius: all of them."""
        found = self.near[0][prints[:, 0]]
        for b in range(1, BLOCKS):
            found = found | self.near[b][prints[:, b]]
        window, item = np.nonzero(found)
        apart = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        close = apart <= self.radius
        return window[close], item[close]


class ItemIndex:
    """A block of benchmark items, ready to be met by documents."""

    def __init__(self, rows: list[tuple], similarity: float = SIMILARITY, radius: int = RADIUS) -> None:
        self.similarity = similarity
        self.ids: list = []
        self.weights: list[Counter] = []
        by_size: dict[int, list[int]] = {}
        shingles: list[np.ndarray] = []
        for item_id, text in rows:
            hashes, _ = word_hashes([words(text)])
            if len(hashes) == 0:
                continue
            by_size.setdefault(len(hashes), []).append(len(self.ids))
            self.ids.append(item_id)
            shingles.append(shingle_hashes(hashes, SHINGLE))
            self.weights.append(Counter(shingles[-1].tolist()))
        self.sizes = [SizeIndex(n, items, [shingles[i] for i in items], radius) for n, items in sorted(by_size.items())]
        #: By shingle length (five words, or the whole of shorter items): all shingles, and a filter on them.
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({min(n, SHINGLE) for n in by_size}):
            mine = [i for n, items in by_size.items() if min(n, SHINGLE) == length for i in items]
            every = np.unique(np.concatenate([shingles[i] for i in mine]))
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[every >> np.uint64(64 - _FILTER_BITS)] = True
            self.known[length] = every, seen

    def hits(self, stream: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, position in it) of the shingles of ``length`` words that some item has."""
        every, seen = self.known[length]
        if len(stream) < length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        shingles = shingle_hashes(stream, length)
        at = np.flatnonzero(seen[shingles >> np.uint64(64 - _FILTER_BITS)])
        place = np.minimum(np.searchsorted(every, shingles[at]), len(every) - 1)
        at = at[every[place] == shingles[at]]
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + length <= offsets[text + 1]
        return text[inside], (at - offsets[text])[inside]

    def similar(self, shingles: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window and an item."""
        mine, other = Counter(shingles.tolist()), self.weights[item]
        lesser = sum(min(n, other[s]) for s, n in mine.items() if s in other)
        return lesser / (len(shingles) + sum(other.values()) - lesser)

    def search(self, hashes: np.ndarray, positions: np.ndarray, length: int, first: bool = False) -> dict[int, tuple]:
        """Best window (similarity, start, words) of each item found around the hits of one text."""
        shingles = shingle_hashes(hashes, length)
        best: dict[int, tuple] = {}
        for size in self.sizes:
            if min(size.size, SHINGLE) != length:
                continue
            width = min(size.width, len(shingles))
            steps = np.zeros(len(shingles) + 1, np.int64)
            np.add.at(steps, np.maximum(positions - width + 1, 0), 1)
            np.add.at(steps, np.minimum(positions, len(shingles) - width) + 1, -1)
            starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
            starts = starts[starts <= len(shingles) - width]
            for at in range(0, len(starts), _WINDOWS_AT_ONCE):
                self._windows(shingles, starts[at : at + _WINDOWS_AT_ONCE], width, size, best)
            if first and best:
                break
        return best

    def _windows(self, shingles: np.ndarray, starts: np.ndarray, width: int, size: SizeIndex, best: dict[int, tuple]) -> None:
        breaks = np.flatnonzero(np.diff(starts) > 1) + 1
        for run in np.split(starts, breaks):
            prints = fingerprints(bits_of(shingles[run[0] : run[-1] + width]), width)
            for window, item in zip(*(x.tolist() for x in size.within(prints))):
                start, number = int(run[window]), int(size.items[item])
                score = self.similar(shingles[start : start + width], number)
                if score >= self.similarity and (number not in best or (score, -start) > (best[number][0], -best[number][1])):
                    best[number] = score, start, width + min(size.size, SHINGLE) - 1

    def find(self, texts: list[str], first: bool = False) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, similarity, start, words) of the passages in some texts."""
        lists = [words(t) for t in texts]
        stream, offsets = word_hashes(lists)
        for length in self.known:
            text, position = self.hits(stream, offsets, length)
            for number in np.unique(text).tolist():
                hashes = stream[offsets[number] : offsets[number + 1]]
                found = self.search(hashes, position[text == number], length, first)
                for item, (score, start, n) in sorted(found.items()):
                    yield number, item, score, start, n


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_items: int = BLOCK_ITEMS) -> Iterator[Broadcast]:
    """The benchmark as broadcast indexes, one at a time; each holds about ``block_items`` items or fewer."""
    rows = benchmark.select(F.col(item).alias("_id"), text_or_empty(text).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("b")).first()
    count = max(-(-size.n // block_items), -(-size.b // BLOCK_BYTES), 1)
    block = F.pmod(F.xxhash64("_id", "text"), F.lit(count))
    for k in range(count):
        items = [(r[0], r[1]) for r in rows.filter(block == k).collect()]
        if any(t.split() for _, t in items):
            yield benchmark.sparkSession.sparkContext.broadcast(ItemIndex(items))


def passages(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """One row per document and item it holds: key, item, ``start_word``, ``words``, ``similarity`` of the best window.

    Words are runs between ASCII white space with A-Z lower-cased; of a text shorter than the item the whole is
    the window; items and texts of fewer than five words have one shingle, the whole sequence. Null and empty
    texts and items hold nothing. Rows that repeat a key are searched each; no rows give no rows; other columns
    are not read. Of equally similar windows the first counts.
    """
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("text"))
    key_kind, item_kind = rows.schema["_key"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    kinds = {"_key": key_kind, "_item": item_kind, "start_word": "bigint", "words": "bigint", "similarity": "double"}
    ddl = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    found = []
    for index in blocks(benchmark, item, text="text", block_items=block_items):

        def run(batches: Iterable[pa.RecordBatch], index: Broadcast = index) -> Iterator[pa.RecordBatch]:
            items = index.value
            for batch in slices(batches):
                hits = list(items.find(batch.column("text").to_pylist()))
                at = pa.array([h[0] for h in hits], pa.int64())
                columns = [
                    batch.column("_key").take(at), pa.array([items.ids[h[1]] for h in hits], item_type),
                    pa.array([h[3] for h in hits], pa.int64()), pa.array([h[4] for h in hits], pa.int64()),
                    pa.array([h[2] for h in hits], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, list(kinds))

        found.append(rows.mapInArrow(run, ddl))
    if not found:  # a benchmark without words
        found = [docs.sparkSession.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()])]
    return reduce(DataFrame.unionByName, found).withColumnsRenamed({"_key": key, "_item": item})


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without those that hold a passage of the benchmark; all columns stay as they are."""
    for index in blocks(benchmark, item, block_items=block_items):
        docs = docs.filter(~_holds(index)(text_or_empty(text)))
    return docs


def _holds(index: Broadcast) -> Callable[[Column], Column]:
    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        marks = np.zeros(len(texts), bool)
        table = pa.record_batch({"text": texts})
        at = 0
        for batch in slices([table]):
            found = {hit[0] for hit in index.value.find(batch.column("text").to_pylist(), first=True)}
            marks[[at + k for k in found]] = True
            at += batch.num_rows
        return pa.array(marks)

    return holds
