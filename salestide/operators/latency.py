"""Latency percentiles from histograms that are kept by window and added over any range.

A latency of whole seconds falls into an integer bucket: one for each second below ``2 ** BITS``, above that ``2 ** (BITS - 1)``
for each power of two. A percentile is given as the middle of the bucket that holds it, which is within a share of
``2 ** -BITS`` of the exact one, for one window as for all of them: adding histograms loses nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import latency_seconds

BITS = 6
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def bucket(seconds: Column) -> Column:
    """The bucket of a latency; that of a negative one is the negative of its opposite's."""
    size, half = F.abs(seconds).cast("bigint"), 1 << (BITS - 1)
    scale = F.length(F.bin(size)) - BITS  # how many low bits are left out
    above = scale * half + F.floor(size / F.pow(F.lit(2.0), scale))
    return (F.signum(seconds) * F.when(size < 2 * half, size).otherwise(above)).cast("int")


def middle(number: Column) -> Column:
    """The latency that stands for a bucket."""
    size, half = F.abs(number), 1 << (BITS - 1)
    scale = F.floor(size / half) - 1
    width = F.pow(F.lit(2.0), scale)
    lowest = (size - scale * half) * width
    value = F.when(size < 2 * half, size).otherwise(lowest + F.floor(width / 2))
    return (F.signum(number) * value).cast("bigint")


def latency_sketches(silver: DataFrame, length: str = c.WINDOW_LENGTH) -> DataFrame:
    """``window_start, window_end, events, buckets`` by event-time window; rows without a latency are left out.

    Counts are summed by each task before the shuffle; a window has at most a few hundred buckets.
    """
    counted = (
        silver.select(F.window("event_ts", length).alias("window"), bucket(latency_seconds()).alias("bucket"))
        .filter(F.col("bucket").isNotNull())
        .groupBy("window", "bucket")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counted.groupBy("window").agg(
        F.sum("count").alias("events"), F.sort_array(F.collect_list(F.struct("bucket", "count"))).alias("buckets")
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events", "buckets")


def merged(sketches: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """``bucket, count`` of all sketches, or of each group of them."""
    return sketches.select(*by, F.inline("buckets")).groupBy(*_names(sketches, by), "bucket").agg(F.sum("count").alias("count"))


def _names(sketches: DataFrame, by: Sequence[Column | str]) -> list[str]:
    return sketches.select(*by).columns if by else []


def percentiles(
    sketches: DataFrame, by: Sequence[Column | str] = (), shares: Mapping[str, float] = PERCENTILES
) -> DataFrame:
    """The percentiles of all windows of each group, a column each, from their sketches."""
    names = _names(sketches, by)
    rising = Window.partitionBy(*names).orderBy("bucket") if names else Window.partitionBy(F.lit(0)).orderBy("bucket")
    upto = merged(sketches, by).withColumn("upto", F.sum("count").over(rising))
    listed = upto.groupBy(*names).agg(
        F.max("upto").alias("events"), F.sort_array(F.collect_list(F.struct("bucket", "upto"))).alias("rising")
    )

    def at(share: float) -> Column:
        rank = F.ceil(F.col("events") * F.lit(share))
        return middle(F.filter("rising", lambda b: b["upto"] >= rank)[0]["bucket"])

    return reduce(lambda df, pair: df.withColumn(pair[0], at(pair[1])), shares.items(), listed).drop("rising")
