"""Kafka in and out. Needs the ``spark-sql-kafka-0-10`` package on the session."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.frames import encode_frame

# How much wider a range of times is read than asked for.
TIME_SLACK_MS = 3_600_000


class KafkaPackageMissing(RuntimeError):
    """The session was started without Spark's Kafka package."""


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """The topic as an unbounded table.

    ``max_offsets_per_trigger`` bounds a batch while catching up; ``min_partitions`` splits a topic
    partition that holds far more than the others over several tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return _load(reader)


def kafka_range(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: Mapping[int, int] | str = "earliest",
    end: Mapping[int, int] | str = "latest",
    min_partitions: int | None = None,
) -> DataFrame:
    """The records between two sets of offsets (end exclusive), as a bounded table."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", _offsets(topic, start))
        .option("endingOffsets", _offsets(topic, end))
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return _load(reader)


def kafka_time_range(
    spark: SparkSession,
    servers: str,
    topic: str,
    start_ms: int,
    end_ms: int,
    min_partitions: int | None = None,
    slack_ms: int = TIME_SLACK_MS,
) -> DataFrame:
    """The records with a timestamp in ``[start_ms, end_ms)``, as a bounded table.

    Kafka finds offsets by time, but where producers set the timestamps, records of the range can lie before
    or after those offsets: the range is read ``slack_ms`` wider on both sides and then filtered.
    """
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingTimestamp", str(max(start_ms - slack_ms, 0)))
        .option("endingTimestamp", str(end_ms + slack_ms))
        .option("startingOffsetsByTimestampStrategy", "latest")
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return in_time_range(_load(reader), start_ms, end_ms)


def in_time_range(records: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Kafka rows with a timestamp in ``[start_ms, end_ms)``."""
    at = F.col("timestamp")
    return records.filter((at >= F.timestamp_millis(F.lit(start_ms))) & (at < F.timestamp_millis(F.lit(end_ms))))


def framed_events(events: DataFrame, schema_id: int, fields: Sequence[str] = c.EVENT_V1.names) -> DataFrame:
    """Typed events as framed JSON records of the contract's ``fields``, keyed by account."""
    body = F.to_json(F.struct(*fields)).cast("binary")
    return events.select(
        F.col("account_id").cast("binary").alias("key"),
        encode_frame(F.lit(schema_id), body).alias("value"),
    )


def publish_events(
    events: DataFrame, schema_id: int, servers: str, topic: str, fields: Sequence[str] = c.EVENT_V1.names
) -> None:
    """Write typed events as framed JSON records, keyed by account so one account stays in order."""
    _save(framed_events(events, schema_id, fields), servers, topic)


def dead_letters(quarantine: DataFrame) -> DataFrame:
    """Quarantined records as JSON ``{error, event}``, keyed as before; the event is the raw value in base64."""
    letter = F.to_json(F.struct("error", F.base64("value").alias("event")))
    return quarantine.select(F.col("kafka_key").cast("binary").alias("key"), letter.cast("binary").alias("value"))


def publish_dead_letters(quarantine: DataFrame, servers: str, topic: str) -> None:
    _save(dead_letters(quarantine), servers, topic)


def _offsets(topic: str, offsets: Mapping[int, int] | str) -> str:
    if isinstance(offsets, str):
        return offsets
    return json.dumps({topic: {str(part): offset for part, offset in offsets.items()}})


def _load(reader) -> DataFrame:
    try:
        return reader.load()
    except AnalysisException as error:
        raise _missing(error) from error


def _save(records: DataFrame, servers: str, topic: str) -> None:
    writer = (
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    )
    try:
        writer.save()
    except AnalysisException as error:
        raise _missing(error) from error


def _missing(error: AnalysisException) -> Exception:
    if "kafka" in str(error).lower() and "data source" in str(error).lower():
        return KafkaPackageMissing("start Spark with --packages org.apache.spark:spark-sql-kafka-0-10_2.13")
    return error
