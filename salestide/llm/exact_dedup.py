"""Exact duplicates by recipes of content-defined chunks.

A normalised text is cut where a rolling hash of its last bytes says so, and so wherever equal passages
stand, they are cut alike. A chunk's identifier is its SHA-256, verified: chunks that share one are compared
byte by byte, and where they should differ, the bytes themselves take the identifier's place. Two texts are
equal exactly when their ordered lists of identifiers are. After chunking, whole texts are not moved again:
only chunks (each input task's copies reduced to one) and lists of identifiers are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.text import keep_one, slices, text_or_empty
from salestide.session import materialize, scratch

# A cut on average every 2 KiB beyond the least size; long runs without a cut are cut at the greatest size.
LEAST, MASK_BITS, MOST = 256, 11, 16384
# Tasks that share the documents of one recipe.
SALTS = 16
SPACE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_LIST = pa.list_(pa.binary())
_GEAR = np.random.default_rng(20240601).integers(0, 1 << 32, 256, dtype=np.uint32)


def normalised(text: str = "text") -> Column:
    """The text with every run of ASCII white space made one space; null becomes empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_RUN, " ")


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a byte array; they depend on nearby bytes only."""
    size = len(data)
    if size <= LEAST:
        return np.array([size] if size else [], np.int64)
    rolling = _GEAR[data]
    for k in (1, 2, 4, 8):  # a gear hash over the last 16 bytes
        shifted = np.zeros_like(rolling)
        shifted[k:] = rolling[:-k] << np.uint32(k)
        rolling = rolling + shifted
    wished = np.flatnonzero((rolling >> np.uint32(32 - MASK_BITS)) == 0) + 1
    ends, last = [], 0
    for end in wished.tolist() + [size]:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST or (end == size and end > last):
            ends.append(end)
            last = end
    return np.array(ends, np.int64)


def _chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids, parts = [], []
        for text in batch.column("text").cast(pa.large_binary()).to_pylist():
            ends = cut_points(np.frombuffer(text, np.uint8)).tolist()
            chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
            parts.append(chunks)
            ids.append([hashlib.sha256(chunk).digest() for chunk in chunks])
        kept = [batch.column(name) for name in ("_row", "_key", "sha")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(ids, _LIST), pa.array(parts, _LIST)], ["_row", "_key", "sha", "ids", "parts"]
        )


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``_row`` (unique), the key, the text's SHA-256 and its list of verified chunk identifiers."""
    rows = docs.select(F.col(key).alias("_key"), normalised(text).alias("text"))
    # The row number and the digest travel beside the chunks, so that the text is read once.
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), "_key", F.sha2("text", 256).alias("sha"), "text")
    kind = docs.schema[key].dataType.simpleString()
    layout = f"_row bigint, _key {kind}, sha string, ids array<binary>, parts array<binary>"
    stored = materialize(numbered.mapInArrow(_chunk, layout), "recipes")
    chunk = stored.select(F.explode(F.arrays_zip("ids", "parts")).alias("c")).select("c.ids", "c.parts")
    # Each input task sends one copy of a chunk; the least and the greatest bytes of an identifier show a clash.
    clashing = materialize(
        chunk.groupBy("ids").agg(F.min("parts").alias("lo"), F.max("parts").alias("hi")).filter("lo <> hi").select("ids"),
        "clashing",
    )
    named = ["_row", F.col("_key").alias(key), F.col("sha").alias("text_sha256")]
    if clashing.isEmpty():
        return stored.select(*named, F.col("ids").alias("recipe"))
    # Documents with identifiers that different chunks share list bytes in place of identifiers.
    unsafe = stored.select("_row", F.explode("ids").alias("ids")).join(clashing, "ids", "left_semi").select("_row").distinct()
    safe = stored.join(unsafe, "_row", "left_anti").select(*named, F.col("ids").alias("recipe"))
    spelled = stored.join(unsafe, "_row", "left_semi").select(*named, F.col("parts").alias("recipe"))
    return safe.unionByName(spelled)


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their normalised forms are; a null text is empty, and empty texts are equal to each
    other. Of equal texts the row with the smallest key stays (a null key counts as the largest); if rows
    share that key, one of them stays. No other column of ``docs`` is read; no rows in give no rows out.
    """
    with scratch(docs.sparkSession) as keep:  # the chunks themselves are needed no more
        listed = keep(materialize(recipes(docs, key, text), "recipe-lists"))
    first = F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.col("_row").alias("row")))
    groups = listed.groupBy("recipe").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    # A recipe with very many copies is met by its documents in several tasks.
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = listed.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int"))
    single = F.col("group_size").isNull()
    return salted.join(spread, ["recipe", "_salt"], "left").select(
        key, F.when(single, F.col(key)).otherwise(F.col("first.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), (single | (F.col("_row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals that of a kept row; all columns stay as they are.

    Null, empty, tied and repeated rows as in :func:`duplicates`; an empty table stays empty.
    """
    return keep_one(docs, lambda: duplicates(docs, key, text), key, "text_sha256", F.sha2(normalised(text), 256))
