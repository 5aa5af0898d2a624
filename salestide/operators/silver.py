"""One row per event id: within a watermark on streams, the first arrival on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.operators.skew import salt

# Tasks that share the copies of one id on a stream; 0 for one task and one state store per id.
STREAM_SALTS = 0
ARRIVAL_ORDER = ("kafka_ingest_ts", "kafka_partition", "kafka_offset")


def first_arrival(
    events: DataFrame, key: str | list[str] = "event_id", order: tuple[str, ...] = ARRIVAL_ORDER
) -> DataFrame:
    """Keep the first row of each key (a column or several) in arrival order.

    ``row_number() = 1`` lets Spark keep one row per key within each input partition before the shuffle,
    so a key with very many copies reaches its task as one row per input partition.
    """
    arrivals = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("_arrival", F.row_number().over(arrivals)).filter("_arrival = 1").drop("_arrival")


def dedup_stream(
    events: DataFrame, watermark: str = c.WATERMARK_DELAY, key: str = "event_id", salts: int = STREAM_SALTS
) -> DataFrame:
    """Keep one row of each key on a stream; state of a key is dropped once the watermark passes it.

    Of copies in one micro-batch any may be kept (they differ in arrival only); of copies in several, the
    one in the first. :func:`first_arrival` always keeps the earliest.

    If single ids make up much of a batch, set ``salts``: copies are then first removed within (key, salt) by
    that many tasks, at the price of a second state store and one more shuffle.
    """
    marked = events.withWatermark("event_ts", watermark)
    if salts > 0:
        salted = marked.withColumn("_salt", salt("kafka_offset", salts))
        marked = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])


def silver(events: DataFrame, watermark: str = c.WATERMARK_DELAY, salts: int = STREAM_SALTS) -> DataFrame:
    """Deduplicate events, on a batch or a stream."""
    return dedup_stream(events, watermark, salts=salts) if events.isStreaming else first_arrival(events)


def duplicate_report(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys that arrived more than once, how often, and when first and last."""
    return (
        events.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("kafka_ingest_ts").alias("first_arrival_ts"),
            F.max("kafka_ingest_ts").alias("last_arrival_ts"),
        )
        .filter("copies > 1")
        .withColumn("extra_copies", F.col("copies") - 1)
    )
