"""Bitmaps of the ids that each partition of a table holds: which partitions need not be opened to look for some ids.

An id is one bit of ``2 ** BITS``; a partition has a row for each bucket of 32,768 bits that is not empty. Bits can clash,
so a partition whose bits meet those of the ids may not hold them, but one whose bits do not meet surely does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the id space: a candidate bitmap has at most 512 KB, as has a partition's.
BITS = 22


def _position(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << BITS))


def bitmaps(rows: DataFrame, by: list[str], key: str = "event_id") -> DataFrame:
    """``by, bucket, bitmap`` of the keys of ``rows``; bits are joined by each task before the shuffle."""
    bits = rows.filter(F.col(key).isNotNull()).select(
        *by, F.bitmap_bucket_number(_position(key)).alias("bucket"), F.bitmap_bit_position(_position(key)).alias("bit")
    )
    return bits.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def meeting(index: DataFrame, by: str, rows: DataFrame, key: str = "event_id") -> list:
    """The partitions (values of ``by``) of ``index`` whose bitmaps share a bit with the keys of ``rows``, in order.

    The driver gets a value for each such partition.
    """
    wanted = F.broadcast(bitmaps(rows, [], key).withColumnRenamed("bitmap", "wanted"))
    held = index.groupBy(by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    pairs = held.join(wanted, "bucket").select(by, "bucket", F.explode(F.array("bitmap", "wanted")).alias("bitmap"))
    shared = pairs.groupBy(by, "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bitmap")).alias("shared"))
    found = shared.filter("shared > 0").select(by).distinct().orderBy(by)
    return [row[0] for row in found.collect()]


def reused_ids(arrivals: DataFrame, stored: DataFrame, index: DataFrame, key: str = "event_id") -> DataFrame:
    """Ids of ``arrivals`` that ``stored`` (by ``event_date``) has under another event time: they count twice.

    The first row of each id on either side in time order is named. Only dates whose bitmap meets the arrivals' are opened.
    """
    dates = meeting(index, "event_date", arrivals, key)
    opened = stored.filter(F.col("event_date").isin(dates) if dates else F.lit(False))
    firsts = opened.groupBy(key).agg(F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"))
    again = arrivals.groupBy(key).agg(F.min("event_ts").alias("reused_event_ts"), F.max("event_ts").alias("last_reused_ts"))
    other = (F.col("first_event_ts") != F.col("last_reused_ts")) | (F.col("last_event_ts") != F.col("reused_event_ts"))
    return firsts.join(again, key).filter(other).select(key, "first_event_ts", "reused_event_ts")
