"""Revenue and event counts per tumbling event-time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import Rules

DIMENSIONS = ("region", "plan_tier")


def revenue_windows(
    silver: DataFrame, length: str = c.WINDOW_LENGTH, dims: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Sum of amount and number of events by window and dimensions, on a batch or a stream.

    A NULL dimension is a group of its own; a NULL amount counts as an event without revenue. Amounts of
    different currencies are added as they are; put ``currency`` in ``dims`` to keep them apart.
    """
    return (
        silver.groupBy(F.window("event_ts", length), *dims)
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *dims,
            "revenue",
            "event_count",
        )
    )


def split_by_rules(silver: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(rows that pass the rules, rows that break one), for jobs that gate revenue on data quality."""
    invalid = rules.invalid()
    return silver.filter(~invalid), silver.filter(invalid)


def watermark_of(events: DataFrame, delay: str = c.WATERMARK_DELAY) -> Column:
    """The watermark after all of ``events`` (batch) as a scalar subquery; Spark keeps milliseconds."""
    newest = F.date_trunc("millisecond", F.max("event_ts"))
    return events.select((newest - F.expr(f"INTERVAL {delay}")).alias("watermark")).scalar()


def closed_windows(gold: DataFrame, events: DataFrame, delay: str = c.WATERMARK_DELAY) -> DataFrame:
    """The windows an append-mode stream would have emitted after seeing ``events``."""
    return gold.filter(F.col("window_end") <= watermark_of(events, delay))


def latest(gold: DataFrame, rows: int = 20) -> DataFrame:
    """The newest gold rows; the dimensions break ties within a window."""
    return gold.orderBy(
        F.desc("window_start"), F.asc_nulls_last("region"), F.asc_nulls_last("plan_tier")
    ).limit(rows)


def with_window_date(gold: DataFrame) -> DataFrame:
    """Add the date that gold files are partitioned by."""
    return gold.withColumn("window_date", F.to_date("window_start"))
