"""Shards by jump consistent hashing, in DataFrame functions only.

A key's shard depends on the key and the number of shards alone; there is no ring table. With one more
shard, a key either keeps its shard or moves into the new one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestide.llm.text import text_or_empty
from salestide.session import materialize

# Jumps that are tried before the exact long way; a key makes about ln(shards) jumps.
FAST_JUMPS = 96


def _written(keys: tuple[str, ...]) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return reduce(lambda a, b: F.concat(a, F.lit(":"), b), parts)


def _jumps(key: Column, shards: int, most: int) -> Column:
    """The last jump below ``shards`` and the next one, as a struct (bucket, next)."""

    def jump(state: Column, step: Column) -> Column:
        drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), step.cast("string")).cast("binary")), 1, 8), 16, 10)
        draw = F.shiftright(drawn.cast("bigint"), 1) + 1
        to = F.floor((state["next"] + 1) * (F.lit(float(1 << 31)) / draw)).cast("bigint")
        moved = F.struct(state["next"].alias("bucket"), to.alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    start = F.struct(F.lit(-1).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("next"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(most - 1)), start, jump)


def jump(keys: tuple[str, ...], shards: int) -> Column:
    """Struct (bucket, next): the shard of a key, and the first shard count - 1 at which it moves.

    Each jump goes at least one bucket further, so ``shards`` jumps always suffice; nearly every key needs
    far fewer, and the rest take the long way.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    key = _written(keys)
    state = _jumps(key, shards, min(shards, FAST_JUMPS))
    if shards <= FAST_JUMPS:
        return state
    return F.when(state["next"] >= shards, state).otherwise(_jumps(key, shards, shards))


def assign(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), shards: int = 16, column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; rows with equal keys share a shard, null keys count as empty."""
    return docs.withColumn(column, jump(keys, shards)["bucket"].cast("int"))


def write_shards(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), shards: int = 16) -> None:
    """Write one folder per shard; no shuffle, each task adds its rows to the folders."""
    assign(docs, keys, shards).write.partitionBy("shard").parquet(path)


def shard_table(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """One row per document: its size, shard, place in the shard, and its shard were there one more.

    Columns: the key, ``size`` (UTF-8 bytes plus 1; a null text has none), ``text_crc32``, ``law`` ("key"),
    ``shard``, ``slot`` (gapless from 0 in key order; ties in any order), ``grown_shard``. Equal keys share a
    shard whatever their texts; a null key counts as empty; an empty table gives an empty one. Other columns
    of ``docs`` are not read.

    Places are counted without bringing a shard together: rows are sorted over all tasks by (shard, key),
    each task numbers its own, and the counts of earlier tasks are added.
    """
    bytes_ = text_or_empty(text).cast("binary")
    state = jump(("_key",), shards)
    narrow = (
        docs.select(
            F.col(key).alias("_key"), (F.octet_length(bytes_).cast("bigint") + 1).alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
        )
        .withColumn("_state", state)
        .select(
            "_key", "size", "text_crc32", F.col("_state.bucket").cast("int").alias("shard"),
            F.when(F.col("_state.next") == shards, F.lit(shards)).otherwise(F.col("_state.bucket")).cast("int")
            .alias("grown_shard"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    order = ["_key", "size", "text_crc32", "_row"]
    dealt = materialize(
        materialize(narrow, "shard-rows").repartitionByRange("shard", *order)
        .withColumn("_part", F.spark_partition_id()),
        "shard-dealt",
    )
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_place", place).join(starts, ["shard", "_part"])
        .select(
            F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("_place") + F.col("_before")).cast("bigint").alias("slot"), "grown_shard",
        )
    )
