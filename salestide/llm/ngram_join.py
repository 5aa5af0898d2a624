"""Near duplicates: documents whose sets of word n-grams have a Jaccard similarity of ``share`` percent or more.

N-grams get one global order, rare first: by how often their hash bucket occurs in the corpus, then by hash.
A set's first tokens in that order (its prefix) meet the prefix of every set it links to. Sets that share a
prefix token and are of like size form a group; groups of the same members are joined once.

Sets are joined by storing them in a trie and walking it (see :mod:`salestide.llm.trie`), in chunks of
bounded size. Only pairs whose parities leave them a chance are joined, so that most documents are never moved: a
set's parities are one or two bits for each token (see :func:`parities`), less than its prefix at usual shares, and mostly
tell sets that share a token by chance from linked ones. First every set is joined with the least member of each of
its groups, which settles groups of near copies in linear time. Groups whose members are not in one
component then are joined part by part, large ones on whole sets at once. Links inside one component change nothing and
are not looked for, except by :func:`links`, which finds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestide.llm import sieve, sums, trie
from salestide.llm.components import connected
from salestide.llm.text import keep_one, shingle_hashes, slices, text_or_empty, word_hashes, words
from salestide.session import discard, fits_broadcast, materialize, release, scratch, small_broadcasts

SHINGLE = 3
# Buckets by whose counts n-grams are ordered, in bits: a fixed table of 2**20 numbers.
ORDER_BITS = 20
# Up to so many times the average count, and up to so many n-grams in any case, a bucket is light.
LIGHT = 8
FEW = 1000
# Sets, and tokens in them, that are joined in one trie.
CHUNK_SETS = 200
CHUNK_TOKENS = 400_000
# Documents whose whole sets are compared are looked up by a broadcast up to this many, by bits of their hashes beyond.
MAX_BROADCAST_WANTED = 50_000
_LOW = np.uint64((1 << (64 - ORDER_BITS)) - 1)
_SHIFT = np.uint64(64 - ORDER_BITS)
_SUM_ROWS = 256


def _shingles(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    stream, offsets = word_hashes([words(t) for t in batch.column("text").to_pylist()])
    for start, stop in zip(offsets[:-1], offsets[1:]):
        yield shingle_hashes(stream[start:stop], size)


@dataclass(frozen=True)
class Order:
    """Rank of each bucket of n-gram hashes, rare buckets first, and how many of the first are light.

    No n-gram of a light bucket is more than ``LIGHT`` times as frequent as buckets are on average: one in 131,072
    of all n-grams, or ``FEW``, if that is more.
    """

    rank: np.ndarray
    light: int


def order_table(docs: DataFrame, size: int = SHINGLE) -> Order:
    """The order of buckets of n-gram hashes by their counts over all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in slices(batches):
            every = list(_shingles(batch, size))
            counts += np.bincount((np.concatenate(every) >> _SHIFT).astype(np.int64), minlength=len(counts))
        yield sums.partial_rows(counts.reshape(_SUM_ROWS, -1))

    total = sums.total(docs.select(text_or_empty("text").alias("text")).mapInArrow(count, sums.DDL))
    counts = np.concatenate(total) if total else np.zeros(1 << ORDER_BITS)
    order = np.argsort(counts, kind="stable")
    rank = np.empty(len(counts), np.uint64)
    rank[order] = np.arange(len(counts), dtype=np.uint64)
    bound = max(LIGHT * counts.mean(), FEW)
    return Order(rank, int(np.searchsorted(counts[order], bound, side="right")))


def ordered_set(shingles: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text as increasing integers, whose order is the global order."""
    return np.unique(rank[(shingles >> _SHIFT).astype(np.int64)] << _SHIFT | (shingles & _LOW))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def parities(tokens: np.ndarray) -> bytes:
    """Whether the tokens of each of some slots, by their low bits, are odd in number: a bit for each.

    There are as many slots as the next power of two of the tokens, 64 at least. Every slot in which two sets differ holds a token
    that only one of them has.
    """
    slots = max(64, 1 << max(len(tokens) - 1, 0).bit_length())
    counts = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _slots(bits: bytes, width: int) -> np.ndarray:
    """Parities over fewer slots, as many as ``width`` bytes have."""
    out = np.frombuffer(bits, np.uint64)
    while out.nbytes > width:
        half = len(out) // 2
        out = out[:half] ^ out[half:]
    return out


def _chance(differ: np.ndarray, n: np.ndarray, other: np.ndarray, share: int) -> np.ndarray:
    """Whether sets of ``n`` and ``other`` tokens may link if at least ``differ`` tokens are in only one of them."""
    common = np.minimum((n + other - differ) // 2, np.minimum(n, other))
    return (trie.PER + share) * common >= share * (n + other)


def may_link(bits: list[bytes], sizes: list[int], share: int = trie.SHARE) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of sets that may link by their parities and sizes: all that do, and few others."""
    width, n, found = min(map(len, bits)), np.asarray(sizes, np.int64), []
    table = np.vstack([_slots(b, width) for b in bits])
    for i in range(len(bits) - 1):
        differ = np.bitwise_count(table[i + 1 :] ^ table[i]).sum(axis=1, dtype=np.int64)
        found += [(i, i + 1 + int(j)) for j in np.flatnonzero(_chance(differ, n[i], n[i + 1 :], share))]
    return found


def _rows(docs: DataFrame, rank: Broadcast, key: str, text: str, size: int, share: int) -> DataFrame:
    """A row per document: ``_row`` (unique), ``_key``, ``mark`` (of the text), ``n``, ``digest``, ``prefix`` and ``bits`` of its set."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), _mark(text).alias("mark"),
        text_or_empty(text).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rank.value
        for batch in slices(batches):
            sets = [ordered_set(s, order) for s in _shingles(batch, size)]
            prefix = [s[: trie.prefix_length(len(s), share)].view(np.int64) for s in sets]
            columns = [batch.column(c) for c in ("_row", "_key", "mark")] + [
                pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array(prefix, pa.list_(pa.int64())), pa.array([parities(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "_key", "mark", "n", "digest", "prefix", "bits"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row bigint, _key {kind}, mark bigint, n bigint, digest binary, prefix array<bigint>, bits binary")


def _mark(text: str) -> Column:
    return F.xxhash64(text_or_empty(text))


def _sets(docs: DataFrame, wanted: DataFrame, rank: Broadcast, key: str, text: str, size: int) -> DataFrame:
    """``cls``, ``n`` and whole set (``tokens``) of the wanted classes (``cls``, ``_key``, ``mark``), from their texts."""
    named = materialize(wanted.select("cls", F.col("_key").alias("_k"), F.col("mark").alias("_m")), "ngram-wanted")
    rows = docs.select(F.col(key).alias("_key"), _mark(text).alias("mark"), text_or_empty(text).alias("text"))
    # Few documents are wanted as a rule: all others stay where they are.
    if fits_broadcast(named, MAX_BROADCAST_WANTED):
        few = F.broadcast(named)
    else:
        few = named.hint("merge")
        rows, _ = sieve.split(rows, named, [rows["_key"], rows["mark"]], [named["_k"], named["_m"]])
    some = (
        rows.join(few, rows["_key"].eqNullSafe(few["_k"]) & (rows["mark"] == few["_m"])).select("cls", "text")
        .dropDuplicates(["cls"])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rank.value
        for batch in slices(batches):
            sets = [ordered_set(s, order).view(np.int64) for s in _shingles(batch, size)]
            columns = [batch.column("cls"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "n", "tokens"])

    return some.mapInArrow(run, "cls bigint, n bigint, tokens array<bigint>")


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as arrays of unsigned integers."""
    flat, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _grouped(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of equal ``names``, which come next to each other: (their values, the other columns of the rows)."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        others = [c for n, c in zip(batch.schema.names, batch.columns) if n not in names]
        rest = [_arrays(c) if pa.types.is_list(c.type) else c.to_pylist() for c in others]
        for now, row in zip(zip(*columns), zip(*rest)):
            if now != key:
                if rows:
                    yield key, rows
                key, rows = now, []
            rows.append(row)
    if rows:
        yield key, rows


def _forest(found: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Of some links, enough to connect what they connect."""
    top = list(range(size))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    kept = []
    for i, j in found:
        a, b = find(i), find(j)
        if a != b:
            top[b] = a
            kept.append((i, j))
    return kept


def _pairs_table(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"]
    )


def _likely(pairs: DataFrame, bits: DataFrame, share: int) -> DataFrame:
    """Those of the pairs (``lead``, ``cls``) that may link by their parities (``cls``, ``n``, ``bits``), as ``a``, ``b``.

    A lead of very many sets is a skewed key of the second join, which Spark splits at run time.
    """
    other = bits.toDF("lead", "n2", "bits2")
    both = pairs.join(bits, "cls").join(other, "lead").select("lead", "cls", "n", "n2", "bits", "bits2")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, n2 = (batch.column(c).to_numpy() for c in ("n", "n2"))
            one, two = (batch.column(c).to_pylist() for c in ("bits", "bits2"))
            differ = np.fromiter((_differ(x, y) for x, y in zip(one, two)), np.int64, len(n))
            kept = batch.filter(pa.array(_chance(differ, n, n2, share)))
            yield pa.RecordBatch.from_arrays([kept.column("lead"), kept.column("cls")], ["a", "b"])

    return both.mapInArrow(judge, "a bigint, b bigint")


def _differ(one: bytes, two: bytes) -> int:
    """In how many slots two sets differ by their parities."""
    width = min(len(one), len(two))
    return int(np.bitwise_count(_slots(one, width) ^ _slots(two, width)).sum(dtype=np.int64))


def _company(pairs: DataFrame, table: DataFrame, share: int, every: bool = False) -> DataFrame:
    """Links (``a``, ``b``) among the company of each ``lead``: its ``cls`` in ``pairs``, and itself.

    ``table`` has the ``tokens`` of the sets, and their sizes ``n``. A large company is dealt to chunks
    of bounded size, each with the lead. Of what meets in a chunk, enough links are returned to
    connect all that is linked, and so every pair of ``pairs`` is decided; with ``every``, all of ``pairs`` that link.
    """
    sized = pairs.join(table.select("cls", F.size("tokens").alias("t")), "cls")
    company = sized.groupBy("lead").agg(F.count(F.lit(1)).alias("m"), F.sum("t").alias("tokens"))
    parts = materialize(
        company.select("lead", _chunks(F.col("m"), F.col("tokens")).alias("parts")),
        "company",
    )
    dealt = pairs.join(parts, "lead").select("lead", F.pmod(F.xxhash64("cls"), F.col("parts")).alias("part"), "cls")
    leads = parts.select("lead", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.col("lead").alias("cls"))
    members = _looked_up(dealt.union(leads), table, "tokens").select("lead", "part", "cls", "n", "tokens")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lead, _), rows in _grouped(batches, ("lead", "part")):
            found = trie.pairs([t for *_, t in rows], [n for _, n, _ in rows], share)
            if not every:
                found = _forest(found, len(rows))
            named = [(rows[i][0], rows[j][0]) for i, j in found]
            if every:
                named = [p for p in named if lead in p]
            if named:
                yield _pairs_table(named)

    return members.repartition("lead", "part").sortWithinPartitions("lead", "part").mapInArrow(join, "a bigint, b bigint").distinct()


def _band(n: Column, share: int) -> Column:
    """Sizes of linked sets differ by a factor of at most ``PER / share``, the width of a band; a little more, against rounding."""
    return F.floor(F.log(n.cast("double")) / float(np.log(trie.PER / share) * 1.0001))


def _groups(prefixes: DataFrame, share: int, light: int) -> DataFrame:
    """Rows (``x``, ``y``, ``cls``, ``n``) of groups: sets of like size that share a prefix token.

    A set belongs to the band of its own size and the next; linked sets have a band in common. A group is named by two
    hashes of its members, so groups of the same members are one.

    A token of one of the first ``light`` buckets is rare (see :class:`Order`): its sets are brought together, once. Tokens of the
    other buckets may be those of very many sets: these are summed up before they are joined, and Spark splits the join.
    """
    token = prefixes.select("cls", "n", F.explode("tokens").alias("token"))
    bucket = F.shiftrightunsigned("token", int(_SHIFT))
    of_token, of_group = Window.partitionBy("token"), Window.partitionBy("token", "band")
    name = {"m": F.count(F.lit(1)), "x": F.bit_xor(F.xxhash64("cls")), "y": F.bit_xor(F.xxhash64("cls", F.lit(1)))}

    def banded(rows: DataFrame) -> DataFrame:
        own = rows.withColumn("own", _band(F.col("n"), share))
        return own.select("token", "cls", "n", F.explode(F.array("own", F.col("own") + 1)).alias("band"))

    rare = banded(token.filter(bucket < light).withColumn("sets", F.count(F.lit(1)).over(of_token)).filter("sets > 1"))
    rare = rare.select("cls", "n", *[value.over(of_group).alias(c) for c, value in name.items()])
    common = token.filter(bucket >= light)
    shared = common.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("token")
    common = materialize(banded(common.join(shared, "token")), "common-tokens")
    named = common.groupBy("token", "band").agg(*[value.alias(c) for c, value in name.items()])
    common = common.join(named, ["token", "band"]).select("cls", "n", *name)
    return materialize(rare.unionByName(common).filter("m > 1").select("x", "y", "cls", "n").distinct(), "groups")


def _leads(member: DataFrame, share: int) -> DataFrame:
    """Pairs (``lead``, ``cls``) of each set and the least member of its groups."""
    lead = member.groupBy("x", "y").agg(F.min(F.struct("cls", "n")).alias("first"))
    n, other = F.col("n"), F.col("first.n")
    alike = trie.PER * F.least(n, other) >= share * F.greatest(n, other)
    return (
        member.join(lead, ["x", "y"]).filter((F.col("cls") != F.col("first.cls")) & alike)
        .select(F.col("first.cls").alias("lead"), "cls").distinct()
    )


def _chunks(sets: Column, tokens: Column) -> Column:
    """How many chunks so many sets with so many tokens make."""
    return F.ceil(F.greatest(sets / CHUNK_SETS, tokens / CHUNK_TOKENS, F.lit(1.0))).cast("bigint")


def _couples(member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How groups of several components are joined: (``dealt``: set to part, ``couples`` of parts).

    ``member`` has ``x``, ``y``, ``cls``, ``n`` and ``comp``. A group is dealt to parts of bounded size. Members
    with the same earlier first group meet in that one, so none of them need meet here, nor do those of one component: large
    shares of either kind get parts of their own, not joined with each other.
    """
    firsts = materialize(member.groupBy("cls").agg(F.min(F.xxhash64("x", "y")).alias("first")), "first-groups")
    by_comp = member.groupBy("x", "y", "comp").agg(F.count(F.lit(1)).alias("m"))
    mixed = by_comp.groupBy("x", "y").agg(F.count(F.lit(1)).alias("comps"), F.sum("m").alias("size"))
    mixed = mixed.filter("comps > 1 AND size > 2")  # of two, one is the other's lead, so the pair is decided
    placed = member.join(mixed, ["x", "y"]).join(firsts, "cls")
    # What keeps a set from having to meet others here: an earlier group, or its component.
    earlier = F.col("first") != F.xxhash64("x", "y")
    label = F.when(earlier, F.struct(F.lit(0).alias("kind"), F.col("first").alias("id"))).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("comp").alias("id"))
    )
    placed = materialize(placed.withColumn("label", label), "placed")
    own = placed.groupBy("x", "y", "label").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"), _chunks(F.count(F.lit(1)), F.sum("n")).alias("own")
    )
    # Labels with few members share the rest of the parts.
    rest = own.filter("own = 1").groupBy("x", "y").agg(_chunks(F.sum("m"), F.sum("t")).alias("rest"))
    own = own.select("x", "y", "label", "own").join(rest, ["x", "y"], "left")
    none = F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("bigint").alias("id"))
    # A group of few sets is one part, whatever their lengths: only parities of its sets are brought together.
    one = F.struct(none.alias("of"), F.lit(0).cast("bigint").alias("k"))
    part = (
        F.when(F.col("size") <= CHUNK_SETS, one)
        .when(F.col("own") > 1, F.struct(F.col("label").alias("of"), F.pmod(F.xxhash64("cls"), F.col("own")).alias("k")))
        .otherwise(F.struct(none.alias("of"), F.pmod(F.xxhash64("label"), F.col("rest")).alias("k")))
    )
    dealt = materialize(
        placed.join(own, ["x", "y", "label"])
        .select("x", "y", "cls", "comp", "size", part.alias("part")),
        "parts",
    )
    parts = dealt.select("x", "y", "size", "part").distinct()
    other = parts.select("x", "y", F.col("part").alias("part2"))
    # Parts are few: a group's size over the size of a part.
    couples = parts.join(other, ["x", "y"]).filter(
        (F.col("part") <= F.col("part2")) & ~((F.col("part.of.kind") >= 0) & (F.col("part.of") == F.col("part2.of")))
    )
    return dealt, couples


def _joined(dealt: DataFrame, couples: DataFrame, table: DataFrame, share: int, whole: bool, every: bool) -> DataFrame:
    """Pairs (``a``, ``b``) of different components that couples of parts have in common.

    ``table`` has the ``tokens`` of the sets if ``whole``, else their ``bits``. From bits come pairs that may link; from whole sets
    links, with ``every`` all of them, else of what meets in a couple enough to connect all that is linked.
    """
    what, meet = ("tokens", trie.pairs) if whole else ("bits", may_link)
    ends = couples.select("x", "y", "part", "part2", F.explode(F.array_distinct(F.array("part", "part2"))).alias("end"))
    of_part = dealt.select("x", "y", F.col("part").alias("end"), "cls", "comp")
    placed = ends.join(of_part, ["x", "y", "end"]).select(
        F.xxhash64("x", "y").alias("group"), F.xxhash64("part", "part2").alias("couple"), (F.col("part") == F.col("part2")).alias("same"),
        "cls", "comp", (F.col("end") == F.col("part")).alias("one"),
    )
    rows = _looked_up(placed, table, what).select("group", "couple", "same", "cls", "comp", "n", "one", what)
    place = ["group", "couple", "same"]

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, same), members in _grouped(batches, tuple(place)):
            found = meet([held for *_, held in members], [n for _, _, n, *_ in members], share)
            apart = []
            for i, j in found:
                a, b = members[i], members[j]
                # Sets of two parts meet here; those of one part do where it is alone.
                if a[1] != b[1] and (a[3] != b[3] or same):
                    apart.append((i, j))
            if whole and not every:
                apart = _forest(apart, len(members))
            named = [(min(p), max(p)) for p in ((members[i][0], members[j][0]) for i, j in apart)]
            if named:
                yield _pairs_table(named)

    found = rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(join, "a bigint, b bigint")
    return found.distinct()


def _looked_up(rows: DataFrame, table: DataFrame, what: str) -> DataFrame:
    """``rows`` with the ``n`` and ``what`` of their ``cls``. Sets that no row asks for stay where they are."""
    stored = materialize(rows, "asked")
    wanted = materialize(stored.select("cls").distinct(), "asked-sets")
    sets = table.select("cls", "n", what)
    if fits_broadcast(wanted, MAX_BROADCAST_WANTED):
        sets = sets.join(F.broadcast(wanted), "cls", "left_semi")
    else:
        sets, _ = sieve.split(sets, wanted, [sets["cls"]], [wanted["cls"]])
    return sets.join(stored, "cls")


class _Corpus:
    """The sets of a table's documents: their classes, prefixes and groups, and whole sets on demand."""

    def __init__(self, docs: DataFrame, key: str, text: str, size: int, share: int) -> None:
        self.docs, self.key, self.text, self.size, self.share = docs.select(F.col(key), F.col(text)), key, text, size, share
        order = order_table(self.docs.select(F.col(text).alias("text")), size)
        self.rank = docs.sparkSession.sparkContext.broadcast(order.rank)
        whole = materialize(_rows(self.docs, self.rank, key, text, size, share), "ngram-rows")
        # Equal sets are one class, named by one of its rows.
        least = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("_row").alias("row")))
        classes = materialize(whole.filter("n > 0").groupBy("digest").agg(least.alias("least"), F.count(F.lit(1)).alias("copies")), "ngram-classes")
        self.named = classes.select(F.col("least.row").alias("cls"), "digest", "least")
        # Of sets with copies, the other rows are left out; most sets have none.
        copied = materialize(classes.filter("copies > 1").select(F.col("digest").alias("_digest"), F.col("least.row").alias("head")), "copied")
        some = whole.filter("n > 0")
        if fits_broadcast(copied, MAX_BROADCAST_WANTED):
            heads = some.join(F.broadcast(copied), F.col("digest") == F.col("_digest"), "left").filter(F.col("head").isNull() | (F.col("head") == F.col("_row")))
        else:
            maybe, alone = sieve.split(some, copied, [some["digest"]], [copied["_digest"]])
            both = maybe.join(copied.hint("merge"), F.col("digest") == F.col("_digest"), "left").filter(F.col("head").isNull() | (F.col("head") == F.col("_row")))
            heads = both.select(*some.columns).union(alone)
        prefixes = materialize(heads.select(F.col("_row").alias("cls"), "_key", "mark", "n", F.col("prefix").alias("tokens"), "bits"), "ngram-prefixes")
        self.rows = materialize(whole.select("_row", "_key", "mark", "n", "digest"), "ngram-keys")
        discard(whole)
        self.heads = materialize(prefixes.select("cls", "_key", "mark", "n", "bits"), "ngram-heads")
        self.bits = self.heads.select("cls", "n", "bits")
        self.member = _groups(prefixes.select("cls", "n", "tokens"), share, order.light)
        discard(prefixes)
        release(docs.sparkSession)

    def whole(self, wanted: DataFrame) -> DataFrame:
        """Whole sets of the wanted classes (``cls``)."""
        heads = self.heads.join(wanted.distinct(), "cls", "left_semi").select("cls", "_key", "mark")
        return materialize(_sets(self.docs, heads, self.rank, self.key, self.text, self.size), "ngram-sets")

    def links(self, pairs: DataFrame, every: bool = False) -> DataFrame:
        """Links among the pairs (``a``, ``b``): enough to connect what is linked, or all."""
        with scratch(pairs.sparkSession) as keep:
            sets = self.whole(pairs.select(F.explode(F.array("a", "b")).alias("cls")))
            led = pairs.select(F.col("a").alias("lead"), F.col("b").alias("cls"))
            found = keep(materialize(_company(led, sets, self.share, every), "links"))
        release(pairs.sparkSession)
        return found

    def near(self) -> DataFrame:
        """Links of sets with the least member of each of their groups, and some more."""
        with scratch(self.member.sparkSession) as keep:
            pairs = materialize(_likely(_leads(self.member, self.share), self.bits, self.share), "near")
            return keep(self.links(pairs))

    def far(self, labelled: DataFrame, every: bool = False) -> DataFrame:
        """Links between different components of the groups of ``labelled`` (``x``, ``y``, ``cls``, ``n``, ``comp``)."""
        with scratch(labelled.sparkSession) as keep:
            dealt, couples = _couples(labelled)
            # In a small group parities say which few pairs to look at. In a large one, many sets have much in common without
            # being linked, and their pairs are not written down: whole sets are joined.
            small, large = F.col("size") <= CHUNK_SETS, F.col("size") > CHUNK_SETS
            found = materialize(_joined(dealt, couples.filter(small), self.bits, self.share, False, every), "far")
            links = keep(self.links(found, every))
            hard = materialize(couples.filter(large), "couples")
            if hard.isEmpty():
                return links
            sets = self.whole(dealt.filter(large).select("cls"))
            return keep(materialize(links.union(_joined(dealt, hard, sets, self.share, True, every)).distinct(), "far-links"))


def links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, share: int = trie.SHARE
) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and whose sets they are: (``a``, ``b``) and (key, ``class_id``, ``links``).

    A class is the documents of one set, named by its least key; ``a`` < ``b`` are names of classes. ``links`` counts the
    documents that a document is linked with, those of its own class included. Documents with empty sets have no class
    and no links; null keys are named null. Parameters and rules as in :func:`join`.
    """
    with small_broadcasts(docs.sparkSession):
        return _links(docs, key, text, size, share)


def _links(docs: DataFrame, key: str, text: str, size: int, share: int) -> tuple[DataFrame, DataFrame]:
    corpus = _Corpus(docs, key, text, size, share)
    alone = corpus.member.select("x", "y", "cls", "n", F.col("cls").alias("comp"))
    # Pairs with the lead of a group, which alone decide groups of two; then all others.
    pairs = materialize(_likely(_leads(corpus.member, share), corpus.bits, share), "led")
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    found = corpus.links(pairs, True).union(corpus.far(alone, True)).select(*ordered).distinct()
    stored = materialize(found, "all-links")
    members = corpus.rows.filter("n > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    classes = materialize(corpus.named.join(members, "digest").select("cls", "digest", F.col("least.key").alias("name"), "copies"), "classes")
    both = stored.union(stored.select("b", "a"))
    of_class = both.join(classes.select(F.col("cls").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    counted = classes.join(of_class, classes["cls"] == of_class["a"], "left").select(
        "digest", F.col("name").alias("class_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")
    )
    membership = corpus.rows.filter("n > 0").join(counted, "digest").select(F.col("_key").alias(key), "class_id", "links")
    empty = corpus.rows.filter("n = 0").select(F.col("_key").alias(key), F.lit(None).cast(docs.schema[key].dataType).alias("class_id"), F.lit(0).cast("bigint").alias("links"))
    names = classes.select("cls", "name")
    named = stored.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b")
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), membership.unionByName(empty)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, share: int = trie.SHARE) -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id``, ``kept``, and ``mark`` (a hash of its text).

    Two sets link from ``share`` percent on. Words are runs between ASCII white space with A-Z lower-cased; a
    set holds the distinct runs of ``size`` words, or the whole sequence of a shorter text. Null texts and texts without words have empty sets, link
    to nothing, and are their own component. ``component_id`` is the smallest key that is reachable by links
    (null keys aside); ``kept`` is true for one row of each component, one with that key. Rows that repeat a
    key or a text are rows like others; no rows give no rows; other columns are not read. Sets are compared
    by 64-bit hashes of their n-grams.
    """
    corpus = _Corpus(docs, key, text, size, share)
    near = corpus.near()
    first = connected(near)
    labelled = materialize(
        corpus.member.join(first, corpus.member["cls"] == first["node"], "left").select(
            "x", "y", "cls", "n", F.coalesce("component", "cls").alias("comp")
        ), "labelled",
    )
    release(docs.sparkSession)
    far = corpus.far(labelled)
    final = first if far.isEmpty() else connected(near.union(far))
    return _result(corpus.rows, corpus.named, final, key)


def _result(rows: DataFrame, named: DataFrame, final: DataFrame, key: str) -> DataFrame:
    comps = materialize(
        named.join(final, named["cls"] == final["node"], "left").select("digest", "least", F.coalesce("component", "cls").alias("comp")),
        "components",
    )
    of_comp = comps.groupBy("comp").agg(F.min("least").alias("top"))
    by_set = comps.join(of_comp, "comp").select("digest", "top")
    # A set that very many documents have is a skewed key of this join, which Spark splits at run time.
    some = rows.filter("n > 0").join(by_set, "digest").select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("top.key").alias("component_id"),
        (F.col("_row") == F.col("top.row")).alias("kept"), "mark",
    )
    none = rows.filter("n = 0").select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("_key").alias("component_id"), F.lit(True).alias("kept"), "mark"
    )
    return some.unionByName(none)


def keep_one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, share: int = trie.SHARE
) -> DataFrame:
    """``docs`` with one row of each component of near duplicates; all columns stay as they are.

    Null, empty, tied and repeated rows as in :func:`join`; an empty table stays empty.
    """
    return keep_one(docs, lambda: join(docs, key, text, size, share), key, "mark", _mark(text))
