"""Feed a stored log to a stream slice by slice, as if it arrived over time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide import contract as c
from salestide.sources.files import parquet_stream

# Rows of a landed file: a slice is read by as many tasks as it has files, however few tasks have written it.
FILE_ROWS = 100_000


def land_slices(records: DataFrame, slice_column: str, path: str) -> list[int]:
    """Write records into one folder per slice, in files of bounded size, without a shuffle, and list the slices in order."""
    records.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(slice_column).parquet(path)
    landed = records.sparkSession.read.parquet(path).select(slice_column).distinct()
    return sorted(row[0] for row in landed.collect())


def replay_slices(
    spark: SparkSession,
    path: str,
    slice_column: str,
    slices: list[int],
    start: Callable[[DataFrame], StreamingQuery],
    schema: T.StructType = c.KAFKA_SCHEMA,
    first: int = 0,
) -> None:
    """Run ``start`` on a growing source: a run per slice, each resuming the checkpoint of the last.

    A run takes its slice as one batch, however many files it has, followed by an empty batch that
    applies the new watermark. So a row of slice b is late if its event time is at or below the
    watermark after slice b-1. ``first`` skips slices that earlier calls have replayed.
    """
    for last in range(first, len(slices)):
        seen = ",".join(str(number) for number in slices[: last + 1])
        source = parquet_stream(spark, f"{path}/{slice_column}={{{seen}}}", schema)
        query = start(source)
        try:
            query.awaitTermination()
        finally:
            query.stop()
