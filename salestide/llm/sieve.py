"""Rows told by a key, where the keys are too many to be broadcast: by bits of their hashes.

A broadcast key costs the driver some hundred bytes, several times over while it is built and sent; here it costs four. Of rows
with other keys, one in ``BITS_A_KEY`` passes by chance, so what passes is joined with the keys themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY = 32
# Bits of one row of Spark's bitmap functions, and of all rows at most: 8 MiB. Beyond, more rows pass by chance.
BLOCK_BITS = 1 << 15
MOST_BLOCKS = 1 << 11


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, case aside."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def split(rows: DataFrame, keys: DataFrame, of_rows: list[Column], of_keys: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys, all that do among them, and the others. No row is moved for it.

    ``keys`` should be stored: they are counted and read. Nulls are values like others; no keys leave all rows in the second part.
    """
    bits = min(MOST_BLOCKS, -(-BITS_A_KEY * keys.count() // BLOCK_BITS) or 1) * BLOCK_BITS
    at, block, held = (free_name(rows, name) for name in ("_place", "_block", "_held"))

    def place(columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1  # Spark's bitmaps count from 1

    blocks = keys.select(place(of_keys).alias(at)).groupBy(F.bitmap_bucket_number(at).alias(block))
    table = blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(held))
    # A column of its own: the hash of a text is computed once.
    placed = rows.withColumn(at, place(of_rows))
    met = placed.join(F.broadcast(table), F.bitmap_bucket_number(placed[at]) == table[block], "left")
    bit = F.bitmap_bit_position(F.col(at))
    byte = F.conv(F.hex(F.substring(held, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    inside = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return met.filter(inside).drop(at, block, held), met.filter(~inside).drop(at, block, held)
