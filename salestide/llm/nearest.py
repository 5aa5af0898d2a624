"""Approximate nearest neighbours by inner product: inverted lists, each scanned adaptively over rotated column blocks.

Vectors are scaled by the largest norm and given one more component that brings them to norm one, so that the nearest by
distance to a query of norm one are those of the largest inner product; then they are rotated at random. Centroids are fitted on a
bounded sample (``SAMPLE`` vectors), all vectors are indexed. Lists are cut into blocks, so a large list is many tasks'
work. A query first scans its nearest list; the distance of its ``k``-th find there is the bound with which it scans the
others. How many lists are probed is measured, not set: ``CALIBRATION`` queries are compared with every vector, and the
least number of lists that holds ``recall`` of their true neighbours is taken. Scores are exact, in double precision.

Rules: vectors that are null, zero, or hold a null or non-finite component take no part, neither do those of another
length than most have (of equally many, the longer). Equal vectors are one entry with the ``k + 1`` smallest ids, which is
all that any query can return of them; null ids come last. Each row is a query or candidate of its own, also where ids
repeat. Queries without candidates, and empty tables, give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.llm import dimension_scan
from salestide.session import local_table, materialize

#: Most vectors that centroids are fitted on, and most lists.
SAMPLE, MAX_LISTS = 65_536, 4096
SAMPLE_BYTES = 64 << 20
#: Queries that are compared with all vectors to choose the number of probed lists.
CALIBRATION = 256
BLOCK, QUERIES_AT_ONCE, QUERIES_OF_A_BLOCK = 1024, 256, 4096
_SEED = 20
_LAST = np.iinfo(np.int64).max


def _valid(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``key, vector`` of the vectors that take part, in double precision, and their length."""
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    chosen = rows.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    chosen = chosen.filter(F.col("vector").isNotNull()).filter(sound)
    most = chosen.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = most["length"] if most else 0
    return chosen.filter(F.size("vector") == length), length


def _matrix(batch: pa.RecordBatch, column: str, length: int) -> np.ndarray:
    """A column of arrays, or of doubles in binary, as the rows of a matrix."""
    values = batch.column(column)
    if pa.types.is_list(values.type):
        return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    return np.frombuffer(b"".join(values.to_pylist()), "<f8").reshape(-1, length)


def _norms(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1)
    return largest * np.sqrt(np.square(rows / largest[:, None]).sum(axis=1))


def _entries(vectors: DataFrame, length: int, k: int) -> DataFrame:
    """One row per distinct vector: ``entry`` (its digest), ``raw``, ``norm``, ``members`` (the k + 1 smallest keys)."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch, "vector", length) + 0.0  # no negative zeros
            raw = [row.astype("<f8").tobytes() for row in rows]
            digests = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(digests, pa.binary()), pa.array(raw, pa.binary()), pa.array(_norms(rows) if len(rows) else [], pa.float64())],
                ["key", "entry", "raw", "norm"],
            )

    return vectors.mapInArrow(digest, "key bigint, entry binary, raw binary, norm double")


class _Space:
    """The rotated space: how vectors and queries are placed, and where the centroids are."""

    def __init__(self, length: int, largest: float) -> None:
        self.length, self.largest = length, largest
        drawn = np.random.default_rng(_SEED).normal(size=(length + 1, length + 1))
        self.rotation = np.linalg.qr(drawn)[0]
        self.centroids = np.zeros((1, length + 1))

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        scaled = rows / self.largest
        rest = np.sqrt(np.maximum(0, 1 - np.square(scaled).sum(axis=1)))
        return np.concatenate([scaled, rest[:, None]], axis=1) @ self.rotation

    def queries(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows / _norms(rows)[:, None], np.zeros((len(rows), 1))], axis=1) @ self.rotation

    def distances(self, placed: np.ndarray) -> np.ndarray:
        """To the centroids, less what is the same for all of them."""
        return np.square(self.centroids).sum(axis=1) - 2 * placed @ self.centroids.T

    def fit(self, placed: np.ndarray, lists: int, rounds: int = 8) -> None:
        """Lloyd's iterations; an empty list keeps its centroid."""
        chosen = np.random.default_rng(_SEED).choice(len(placed), min(lists, len(placed)), replace=False)
        self.centroids = placed[np.sort(chosen)]
        for _ in range(rounds):
            nearest = np.concatenate([self.distances(placed[i : i + 4096]).argmin(axis=1) for i in range(0, len(placed), 4096)])
            size = np.bincount(nearest, minlength=len(self.centroids))
            order = np.argsort(nearest, kind="stable")
            sums = np.add.reduceat(placed[order], np.minimum(np.cumsum(size) - size, len(placed) - 1))
            self.centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], self.centroids)


def _space(entries: DataFrame, length: int, lists: int | None) -> _Space:
    total = entries.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("largest")).first()
    space = _Space(length, total["largest"])
    lists = lists or max(1, min(MAX_LISTS, int(total["n"] ** 0.5)))
    size = min(SAMPLE, SAMPLE_BYTES // (8 * length), 64 * lists)
    # Digests are as good as random: those below a bound are a sample.
    drawn = F.conv(F.hex(F.substring("entry", 1, 4)), 16, 10).cast("bigint") < int(2**32 * min(1.0, 1.1 * size / total["n"]))
    sample = entries.filter(drawn).select("raw").limit(size).collect() or entries.select("raw").limit(1).collect()
    rows = np.frombuffer(b"".join(r.raw for r in sample), "<f8").reshape(-1, length)
    space.fit(space.vectors(rows), lists)
    return space


def _listed(entries: DataFrame, space: _Space) -> DataFrame:
    """``list, entry, raw, first`` of every entry."""

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest = space.distances(space.vectors(_matrix(batch, "raw", space.length))).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest, pa.int32()), batch.column("entry"), batch.column("raw"), batch.column("first")],
                    ["list", "entry", "raw", "first"],
                )

    first = F.coalesce(F.element_at("members", 1), F.lit(_LAST)).alias("first")
    return entries.select("entry", "raw", first).mapInArrow(assign, "list int, entry binary, raw binary, first bigint")


def _top(scores: np.ndarray, firsts: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` best of each group, by falling score, then first key."""
    order = np.lexsort((firsts, -scores, group))
    group = group[order]
    begins = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(begins, np.arange(len(group)), 0))
    return order[place < k]


def _probes(listed: DataFrame, queries: DataFrame, space: _Space, k: int, recall: float) -> int:
    """Least number of lists that hold ``recall`` of the true neighbours of some queries, found by comparing them with all."""
    some = queries.orderBy("entry").limit(CALIBRATION).collect()
    raw = np.frombuffer(b"".join(r.raw for r in some), "<f8").reshape(-1, space.length)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            rows, lists = _matrix(batch, "raw", space.length), batch.column("list").to_numpy()
            firsts = batch.column("first").to_numpy()
            for start in range(0, len(rows), 4096):
                scores = raw @ rows[start : start + 4096].T
                here = min(k, scores.shape[1])
                at = np.argpartition(-scores, here - 1, axis=1)[:, :here]
                of = np.repeat(np.arange(len(raw)), here)
                at = at.ravel()
                kept = [np.concatenate(x) for x in zip(kept, [scores[of, at], firsts[start + at], lists[start + at].astype(np.int64), of])]
                best = _top(kept[0], kept[1], kept[3], k)
                kept = [x[best] for x in kept]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], ["score", "first", "list", "query"])

    each = listed.mapInArrow(compare, "score double, first bigint, list bigint, query bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    true = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query", "list").collect()
    ranks = np.argsort(np.argsort(space.distances(space.queries(raw)), axis=1, kind="stable"), axis=1)
    needed = np.sort([ranks[r["query"], r["list"]] + 1 for r in true])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1


_FOUND = "query binary, entry binary, score double, first bigint, distance double"


def _packed(listed: DataFrame, blocks: DataFrame, space: _Space) -> DataFrame:
    """Blocks of lists in column blocks: ``list, block, entries, firsts, raws, columns``."""
    cut = listed.join(F.broadcast(blocks), "list")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))
    names = ["list", "block", "entries", "firsts", "raws", "columns"]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def closed() -> pa.RecordBatch:
            raws = b"".join(r["raw"] for r in rows)
            placed = space.vectors(np.frombuffer(raws, "<f8").reshape(-1, space.length))
            firsts = np.array([r["first"] for r in rows], "<i8").tobytes()
            values = [now[0], now[1], b"".join(r["entry"] for r in rows), firsts, raws, dimension_scan.column_blocks(placed)]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if i < 2 else pa.binary()) for i, v in enumerate(values)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if now != (row["list"], row["block"]) or len(rows) == 4 * BLOCK:
                    if rows:
                        yield closed()
                    now, rows = (row["list"], row["block"]), []
                rows.append(row)
        if rows:
            yield closed()

    sorted_rows = cut.repartition("list", "block").sortWithinPartitions("list", "block", "entry")
    return sorted_rows.select("list", "block", "entry", "raw", "first").mapInArrow(
        pack, "list int, block int, entries binary, firsts binary, raws binary, columns binary"
    )


def _asked(queries: DataFrame, space: _Space, start: int, stop: int) -> DataFrame:
    """``list, query, raw, bound`` of each query and each of the lists that rank from ``start`` to ``stop`` for it."""

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                order = np.argsort(space.distances(space.queries(_matrix(part, "raw", space.length))), axis=1, kind="stable")[:, start:stop]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(order) + 1) * order.shape[1], pa.int32()), pa.array(order.ravel(), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("entry"), part.column("raw"), part.column("bound"), lists], ["query", "raw", "bound", "lists"]
                )

    ranked = queries.select("entry", "raw", "bound").mapInArrow(rank, "query binary, raw binary, bound double, lists array<int>")
    return ranked.select(F.explode("lists").alias("list"), "query", "raw", "bound")


def _scanned(packed: DataFrame, blocks: DataFrame, asked: DataFrame, space: _Space, k: int, epsilon: float) -> DataFrame:
    """What queries find in the lists they ask. A block and the queries of its list meet as a stream: first the block."""
    many = asked.groupBy("list").count().select("list", F.ceil(F.col("count") / QUERIES_OF_A_BLOCK).cast("int").alias("shares"))
    sizes = local_table(
        asked.sparkSession, [(r["list"], r["shares"]) for r in many.collect()],
        T.StructType.fromDDL("list int, shares int"),
    )
    each = lambda count: F.sequence(F.lit(0), count - 1)
    left = packed.join(F.broadcast(sizes), "list").withColumn("share", F.explode(each(F.col("shares")))).drop("shares")
    right = asked.join(F.broadcast(sizes), "list").join(F.broadcast(blocks), "list")
    right = right.withColumn("share", F.pmod(F.xxhash64("query"), F.col("shares")).cast("int"))
    right = right.withColumn("block", F.explode(each(F.col("blocks")))).drop("shares", "blocks")
    keys = ["list", "block", "share"]
    both = left.withColumn("kind", F.lit(0)).unionByName(right.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    columns = [*keys, "kind", "entries", "firsts", "raws", "columns", "query", "raw", "bound"]

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, [], []

        def answered() -> Iterator[pa.RecordBatch]:
            raw = np.frombuffer(b"".join(r["raw"] for r in waiting), "<f8").reshape(-1, space.length)
            bounds = np.array([r["bound"] for r in waiting])
            for block in held:
                entries, firsts, raws, parts = block
                query, candidate, distance = dimension_scan.scan(parts, space.queries(raw), bounds, k, epsilon)
                scores = np.einsum("ij,ij->i", raw[query], raws[candidate])
                best = _top(scores, firsts[candidate], query, k)
                query, candidate, distance, scores = query[best], candidate[best], distance[best], scores[best]
                yield pa.RecordBatch.from_arrays([
                    pa.array([waiting[q]["query"] for q in query], pa.binary()),
                    pa.array([entries[16 * c : 16 * c + 16] for c in candidate], pa.binary()),
                    pa.array(scores), pa.array(firsts[candidate], pa.int64()), pa.array(distance),
                ], ["query", "entry", "score", "first", "distance"])

        for batch in batches:
            for row in batch.to_pylist():
                key = row["list"], row["block"], row["share"]
                if key != now or len(waiting) >= QUERIES_AT_ONCE:
                    if waiting:
                        yield from answered()
                    waiting = []
                if key != now:
                    now, held = key, []
                if row["kind"] == 0:
                    raws = np.frombuffer(row["raws"], "<f8").reshape(-1, space.length)
                    parts = dimension_scan.from_column_blocks(row["columns"], space.length + 1)
                    held.append((row["entries"], np.frombuffer(row["firsts"], "<i8"), raws, parts))
                else:
                    waiting.append(row)
        if waiting:
            yield from answered()

    dealt = both.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return dealt.mapInArrow(meet, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def search(
    rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.96,
    lists: int | None = None, epsilon: float = dimension_scan.EPSILON,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row where ``is_query`` holds, the ``k`` nearest other rows that were found.

    ``is_query`` is about the key, as column ``key``. Ties go to the smaller key. ``recall`` is the share of true
    neighbours whose lists are probed; the tests that abandon candidates take little from it (``epsilon``: how far they
    let a partial distance go beyond the bound; infinite for none).
    """
    spark = rows.sparkSession
    result = "query_id bigint, rank int, vec_id bigint, score double"
    valid, length = _valid(rows, key, vector)
    if not length:
        return spark.createDataFrame([], result)
    vectors = materialize(_entries(valid, length, k), "vectors")
    copies = Window.partitionBy("entry").orderBy(F.col("key").asc_nulls_last())
    few = vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    members = F.transform(F.array_sort(F.collect_list(F.struct("copy", "key"))), lambda m: m["key"])
    entries = materialize(few.groupBy("entry").agg(F.first("raw").alias("raw"), F.first("norm").alias("norm"), members.alias("members")), "entries")
    asking = vectors.filter(is_query).select("key", "entry")
    asked_entries = asking.select("entry").distinct()
    queries = materialize(entries.join(asked_entries, "entry", "left_semi").select("entry", "raw"), "queries")
    if queries.isEmpty():
        return spark.createDataFrame([], result)
    space = _space(entries, length, lists)
    listed = materialize(_listed(entries, space), "listed")
    sizes = listed.groupBy("list").count().collect()
    blocks = local_table(spark, [(r["list"], -(-r["count"] // BLOCK)) for r in sizes], T.StructType.fromDDL("list int, blocks int"))
    packed = materialize(_packed(listed, blocks, space), "packed")
    probes = _probes(listed, queries, space, k, recall)
    # Own entry included, so one more than asked for.
    wanted = k + 1
    unbounded = F.lit(4.1)  # beyond any squared distance of two vectors of norm one

    def scanned(asking: DataFrame, start: int, stop: int) -> DataFrame:
        asked = materialize(_asked(asking, space, start, stop), "asked")
        return _scanned(packed, blocks, asked, space, wanted, epsilon)

    nearest = materialize(scanned(queries.withColumn("bound", unbounded), 0, 1), "found")
    bounds = _best(nearest, wanted).filter(F.col("place") == wanted).select(F.col("query").alias("entry"), F.col("distance").alias("bound"))
    bounded = queries.join(bounds, "entry", "left").withColumn("bound", F.coalesce("bound", unbounded))
    found = nearest
    if probes > 1:
        found = found.unionByName(scanned(bounded, 1, probes))
    best = materialize(_best(found, wanted).select("query", "entry", "score"), "best")
    return _ranked(best, entries, asking, k)


def _ranked(best: DataFrame, entries: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The rows behind the entries found, without the query's own."""
    named = best.join(entries.select("entry", "members"), "entry")
    whole = named.groupBy("query").agg(F.collect_list(F.struct("entry", "score", "members")).alias("found"))
    joined = asking.join(whole, asking["entry"] == whole["query"])

    def others(of: Column) -> Column:
        at = F.array_position(of["members"], F.col("key")).cast("int")
        rest = F.concat(F.slice(of["members"], F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(of["members"], at + 1, F.size(of["members"])))
        return F.when((of["entry"] == F.col("query")) & (at > 0), rest).otherwise(of["members"])

    def listed(of: Column) -> Column:
        return F.transform(others(of), lambda m: F.struct((-of["score"]).alias("s"), m.isNull().alias("n"), m.alias("m")))

    nearest = F.slice(F.array_sort(F.flatten(F.transform("found", listed))), 1, k)
    return joined.select(F.col("key").alias("query_id"), F.posexplode(nearest).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.m").alias("vec_id"), (-F.col("hit.s")).alias("score")
    )
