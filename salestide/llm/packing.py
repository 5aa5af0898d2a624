"""Best-fit packing of documents into sequences, improved by a local search over underfull bins.

Each input task packs its own pieces in groups of bounded size: best fit by decreasing length, then a local
search that moves pieces, exchanges one for one and two for one between underfull bins whenever that raises
the sum of squared fills, so that full bins fill up and the emptiest run empty. Bins that are not full are then pooled and
packed again together with those of other tasks; those that stay clearly underfull over and over, until they are one group
or no longer shrink.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salestide.llm.text import slices, text_or_empty
from salestide.llm.tokens import encoder
from salestide.session import materialize

SEQUENCE_TOKENS = 1024
END_ID = 2
# Pieces packed together by one task; what it holds at once.
GROUP_PIECES = 16_384
# Every bin that is not full is pooled once; after that, those filled below this share.
POOL_BELOW = 0.98
SWEEPS = 12
# Sizes that one trial of two pieces for one begins with.
TWO_FOR_ONE_SIZES = 4
_END = np.array([END_ID], "<u4").tobytes()
_SHIFT = 33


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, longest first, goes into the fullest bin that has room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have left
    present = 0  # bit r is set when some bin has room r
    bins: list[list[int]] = []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[piece]
        fitting = present >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                present &= ~(1 << left)
            bins[number].append(piece)
            left -= size
        else:
            number, left = len(bins), capacity - size
            bins.append([piece])
        room[left].append(number)
        present |= 1 << left
    return bins


class _Emptier:
    """Pieces of the bins that are not yet settled, by size."""

    def __init__(self, sizes: list[int], bins: list[list[int]], fill: list[int]) -> None:
        self.sizes, self.bins, self.fill = sizes, bins, fill
        self.where: dict[int, dict[int, int]] = {}  # size -> piece -> bin
        #: For each size, (fill of the bin, piece); entries that are out of date are passed over when they come up.
        self.emptiest: dict[int, list[tuple[int, int]]] = {}
        self.present = 0

    def add(self, piece: int, number: int) -> None:
        size = self.sizes[piece]
        self.where.setdefault(size, {})[piece] = number
        self.present |= 1 << size
        heapq.heappush(self.emptiest.setdefault(size, []), (self.fill[number], piece))

    def emptied(self, number: int) -> None:
        """Bin ``number`` has become emptier: its pieces come up earlier."""
        for piece in self.bins[number]:
            heapq.heappush(self.emptiest[self.sizes[piece]], (self.fill[number], piece))

    def remove(self, piece: int) -> None:
        size = self.sizes[piece]
        held = self.where[size]
        del held[piece]
        if not held:
            self.present &= ~(1 << size)

    def largest_up_to(self, most: int) -> int:
        """The greatest size present that is at most ``most``; 0 if none is."""
        return (self.present & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else 0

    def pick(self, size: int) -> tuple[int, int]:
        """A piece of this size in the emptiest bin that has one; of equally empty ones, the piece of least number."""
        held, heap = self.where[size], self.emptiest[size]
        while True:
            fill, piece = heap[0]
            number = held.get(piece)
            if number is not None and self.fill[number] == fill:
                return piece, number
            heapq.heappop(heap)

    def smallest(self) -> int:
        """The least size present; 0 if there is none."""
        return (self.present & -self.present).bit_length() - 1 if self.present else 0


def _improve(a: int, capacity: int, rest: _Emptier) -> bool:
    """Fill bin ``a`` further from emptier bins, by the exchange that leaves it the least room."""
    sizes, bins, fill = rest.sizes, rest.bins, rest.fill
    gap = capacity - fill[a]
    best: tuple[int, tuple[int, ...], tuple[int, ...]] | None = None  # gain, out of a, sizes in

    def offer(out: tuple[int, ...], wanted: tuple[int, ...], gain: int) -> None:
        nonlocal best
        if 0 < gain <= gap and (best is None or gain > best[0]):
            best = (gain, out, wanted)

    held = bins[a]
    size = rest.largest_up_to(gap)
    if size > 0:
        offer((), (size,), size)
    for i, x in enumerate(held):
        if best and best[0] == gap:
            break
        size = rest.largest_up_to(min(sizes[x] + gap, capacity))
        if size > sizes[x]:
            offer((x,), (size,), size - sizes[x])
        for z in held[i + 1 :]:
            both = sizes[x] + sizes[z]
            size = rest.largest_up_to(min(both + gap, capacity))
            if size > both:
                offer((x, z), (size,), size - both)
    if not (best and best[0] == gap):
        for x in held:
            best_pair = _two_for_one(sizes[x], gap, rest)
            if best_pair and (best is None or best_pair[0] > best[0]):
                best = (best_pair[0], (x,), best_pair[1])
                if best[0] == gap:
                    break
    if best is None:
        return False
    _, out, wanted = best
    pieces = []
    if len(wanted) == 2:
        _, giver = rest.pick(wanted[0])
        for size in wanted:
            piece = next(p for p in bins[giver] if sizes[p] == size and p not in pieces)
            pieces.append(piece)
    else:
        piece, giver = rest.pick(wanted[0])
        pieces.append(piece)
    for piece in pieces:
        rest.remove(piece)
        bins[giver].remove(piece)
        bins[a].append(piece)
    for piece in out:
        bins[a].remove(piece)
        bins[giver].append(piece)
        rest.add(piece, giver)  # under its old fill; the new one follows
    moved = sum(sizes[p] for p in pieces) - sum(sizes[p] for p in out)
    fill[a] += moved
    fill[giver] -= moved
    rest.emptied(giver)
    return True


def _two_for_one(size: int, gap: int, rest: _Emptier) -> tuple[int, tuple[int, int]] | None:
    """Two sizes of one emptier bin that together are a little more than ``size``."""
    best = None
    # The greater of the two is at least half of their sum, and leaves room for some other piece.
    y = rest.largest_up_to(size + gap - max(rest.smallest(), 1))
    tried = 0
    while 2 * y > size and tried < TWO_FOR_ONE_SIZES:
        piece, number = rest.pick(y)
        for other in rest.bins[number]:
            both = y + rest.sizes[other]
            if other != piece and size < both <= size + gap and (best is None or both - size > best[0]):
                best = (both - size, (y, rest.sizes[other]))
        if best and best[0] == gap:
            break
        y = rest.largest_up_to(y - 1)
        tried += 1
    return best


def local_search(sizes: list[int], bins: list[list[int]], capacity: int, sweeps: int = SWEEPS) -> list[list[int]]:
    """Bins of the same pieces with no smaller sum of squared fills, without those that ran empty.

    A sweep takes underfull bins from the fullest down. Each takes from bins that are no fuller than itself:
    a piece that fits, or a piece for one or two of its own, or two of one bin for one of its own, whichever
    leaves it the least room. Since the taking bin is at least as full, every exchange raises the sum of
    squares; sweeps end when none does.
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[p] for p in b) for b in bins]
    for _ in range(sweeps):
        order = sorted((n for n in range(len(bins)) if 0 < fill[n] < capacity), key=lambda n: (-fill[n], n))
        rest = _Emptier(sizes, bins, fill)
        for number in order:
            for piece in bins[number]:
                rest.add(piece, number)
        changed = False
        while order:
            number = order.pop(0)
            for piece in bins[number]:
                rest.remove(piece)
            while 0 < fill[number] < capacity and _improve(number, capacity, rest):
                changed = True
        if not changed:
            break
    return [b for b in bins if b]


def pack_sizes(sizes: list[int], capacity: int = SEQUENCE_TOKENS) -> list[list[int]]:
    """Piece numbers by bin: best fit, then local search."""
    return local_search(sizes, best_fit(sizes, capacity), capacity)


def _pieces(batches: Iterable[pa.RecordBatch], capacity: int, vocabulary: str | None) -> Iterator[tuple]:
    """(key, piece, start, length, crc32, ids) of the documents, cut only where they are too long."""
    tokens = encoder(vocabulary)
    for batch in slices(batches):
        for key, text in zip(batch.column("_key"), batch.column("text").to_pylist()):
            ids = tokens.encode(text) + _END
            n = len(ids) // 4
            first = n % capacity or capacity
            starts = [0, *range(first, n, capacity)]
            for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n])):
                part = ids[4 * start : 4 * stop]
                yield key, piece, start, stop - start, zlib.crc32(part), part


def _groups(pieces: Iterable[tuple], capacity: int, base: int) -> Iterator[list[tuple]]:
    """The pieces with (sequence, offset, fill) added, group by group."""
    number = base

    def packed(loose: list[tuple]) -> list[tuple]:
        nonlocal number
        rows = []
        for members in pack_sizes([p[3] for p in loose], capacity):
            offset, fill = 0, sum(loose[m][3] for m in members)
            for m in members:
                rows.append((*loose[m], number, offset, fill))
                offset += loose[m][3]
            number += 1
        return rows

    loose: list[tuple] = []
    full: list[tuple] = []
    for piece in pieces:
        if piece[3] == capacity:
            full.append((*piece, number, 0, capacity))
            number += 1
        else:
            loose.append(piece)
        if len(full) >= GROUP_PIECES:
            yield full
            full = []
        if len(loose) >= GROUP_PIECES:
            yield packed(loose)
            loose = []
    if full or loose:
        yield full + packed(loose)


def _batches(groups: Iterable[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for rows in groups:
        for start in range(0, len(rows), 4096):
            columns = zip(*rows[start : start + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _layout(key_type: pa.DataType, keep_ids: bool) -> pa.Schema:
    fields = [("_key", key_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if keep_ids else []
    return pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())])


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence.

    Columns: the key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, and with
    ``keep_ids`` the piece's ``ids`` as little-endian 32-bit integers. A document is its ids and one end id;
    only documents longer than ``capacity`` are cut, and then only the first piece is shorter than it. Null
    texts are empty and so have the end id alone; null and repeated keys are packed like others, row by row.
    No rows give no rows; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("text"))
    schema = _layout(to_arrow_type(rows.schema["_key"].dataType), keep_ids)
    kind = rows.schema["_key"].dataType.simpleString()
    ddl = f"_key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
    ddl += ("ids binary, " if keep_ids else "") + "sequence_id bigint, offset bigint, fill bigint"

    def first_round(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((k.as_py(), *p) if keep_ids else (k.as_py(), *p[:-1]) for k, *p in _pieces(batches, capacity, vocabulary))
        yield from _batches(_groups(pieces, capacity, TaskContext.get().partitionId() << _SHIFT), schema)

    done = materialize(rows.mapInArrow(first_round, ddl), "packed-0")
    settled, pool = done.filter(F.col("fill") == capacity), done.filter(F.col("fill") < capacity)
    low = int(POOL_BELOW * capacity)
    waiting = pool.count()
    names = [f.name for f in schema][:-3]
    for turn in range(1, 64):
        if waiting == 0:
            break
        groups = -(-waiting // GROUP_PIECES)

        def again(batches: Iterable[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            loose = (tuple(row[name] for name in names) for b in batches for row in b.to_pylist())
            yield from _batches(_groups(loose, capacity, turn << 57 | TaskContext.get().partitionId() << _SHIFT), schema)

        dealt = pool.repartition(groups, F.xxhash64("sequence_id", F.lit(turn))) if groups > 1 else pool.coalesce(1)
        done = materialize(dealt.mapInArrow(again, ddl), f"packed-{turn}")
        if groups == 1:
            settled = settled.unionByName(done)
            break
        settled, pool = settled.unionByName(done.filter(F.col("fill") >= low)), done.filter(F.col("fill") < low)
        left = pool.count()
        if turn > 1 and left > 0.9 * waiting:
            settled = settled.unionByName(pool)
            break
        waiting = left
    else:
        settled = settled.unionByName(pool)
    return settled.drop("fill").withColumnRenamed("_key", key)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids in order (little-endian 32-bit, as bytes) and how many; needs ``keep_ids``.

    No rows give no rows; every document has an end, so no sequence is empty.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda so_far, row: F.concat(so_far, row["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("tokens"))
