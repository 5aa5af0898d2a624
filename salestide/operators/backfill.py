"""Bounded replays, their comparison with production, and the merge of replayed windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide import contract as c

GOLD_KEYS = ("window_start", "region", "plan_tier")


def offset_ranges(bronze: DataFrame) -> DataFrame:
    """The offsets that each arrival date of stored bronze holds, by partition: a row for each date and partition."""
    return bronze.groupBy("ingest_date", "kafka_partition").agg(
        F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset")
    )


def replay_by_offset(
    bronze: DataFrame, ranges: Mapping[int, tuple[int, int]], days: DataFrame | None = None
) -> DataFrame:
    """Bronze rows in ``{partition: (start, end)}`` offset ranges, end exclusive.

    With ``days`` (:func:`offset_ranges` of that bronze, stored), only the arrival dates that can hold such rows are opened.
    """
    def within(first: Column, last: Column) -> Column:
        wanted = [
            (F.col("kafka_partition") == part) & (last >= start) & (first < end) for part, (start, end) in ranges.items()
        ]
        return reduce(or_, wanted, F.lit(False))

    chosen = bronze.filter(within(F.col("kafka_offset"), F.col("kafka_offset")))
    if days is None:
        return chosen
    held = days.filter(within(F.col("first_offset"), F.col("last_offset"))).select("ingest_date").distinct().collect()
    return chosen.filter(F.col("ingest_date").isin([row[0] for row in held]) if held else F.lit(False))


def replay_by_time(bronze: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Bronze rows with a broker timestamp in ``[start, end)``; of stored bronze only those days are opened."""
    arrived, first, last = F.col("kafka_ingest_ts"), _moment(start), _moment(end)
    wanted = (arrived >= first) & (arrived < last)
    if "ingest_date" in bronze.columns:
        wanted &= F.col("ingest_date").between(F.to_date(first), F.to_date(last))
    return bronze.filter(wanted)


def _moment(time: datetime | str) -> Column:
    return F.lit(time).cast("timestamp")


def seen_in_full(start: datetime | str, end: datetime | str, delay: str = c.WATERMARK_DELAY) -> Column:
    """Whether a replay of arrivals in ``[start, end)`` has seen all of a window.

    Events of a window arrive from its start until the watermark delay after its end. Windows at the
    edges of the range lack some of theirs, and must not replace complete ones.
    """
    last_end = _moment(end) - F.expr(f"INTERVAL {delay}")
    return (F.col("window_start") >= _moment(start)) & (F.col("window_end") <= last_end)


def complete_windows(
    gold: DataFrame, start: datetime | str, end: datetime | str, delay: str = c.WATERMARK_DELAY
) -> DataFrame:
    """The windows that a replay of arrivals in ``[start, end)`` has seen in full."""
    return gold.filter(seen_in_full(start, end, delay))


def gold_diff(
    production: DataFrame, replay: DataFrame, keys: Sequence[str] = GOLD_KEYS, tolerance: float = 0.005
) -> DataFrame:
    """Compare two gold tables key by key; NULL keys match each other.

    ``status`` is ``same``, ``changed``, ``only_production`` or ``only_replay``.
    """
    left, right = production.alias("p"), replay.alias("r")
    matching = reduce(and_, [F.col(f"p.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys])
    joined = left.join(right, matching, "full_outer")
    in_production, in_replay = F.col("p.event_count").isNotNull(), F.col("r.event_count").isNotNull()
    # One NULL revenue (a group without any amount) against a number is a change, two are not.
    revenue_moved = ~F.coalesce(
        F.abs(F.col("r.revenue") - F.col("p.revenue")) <= tolerance,
        F.col("r.revenue").eqNullSafe(F.col("p.revenue")),
    )
    changed = revenue_moved | (F.col("p.event_count") != F.col("r.event_count"))
    status = (
        F.when(~in_replay, "only_production")
        .when(~in_production, "only_replay")
        .when(changed, "changed")
        .otherwise("same")
    )
    return joined.select(
        *[
            F.when(in_production, F.col(f"p.{key}")).otherwise(F.col(f"r.{key}")).alias(key)
            for key in keys
        ],
        F.col("p.revenue").alias("revenue_production"),
        F.col("r.revenue").alias("revenue_replay"),
        F.col("p.event_count").alias("events_production"),
        F.col("r.event_count").alias("events_replay"),
        status.alias("status"),
    )


def gold_totals(production: DataFrame, replay: DataFrame) -> DataFrame:
    """Row counts and sums of both tables, one row per side."""

    def totals(gold: DataFrame, side: str) -> DataFrame:
        return gold.agg(
            F.count(F.lit(1)).alias("gold_rows"),
            F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"),
            F.sum("revenue").alias("revenue"),
            F.min("window_start").alias("first_window"),
            F.max("window_start").alias("last_window"),
        ).select(F.lit(side).alias("side"), "*")

    return totals(production, "production").unionByName(totals(replay, "replay"))


def merge_windows(
    production: DataFrame, replay: DataFrame, start: datetime | str, end: datetime | str, delay: str = c.WATERMARK_DELAY
) -> DataFrame:
    """Production with everything in the replayed range taken from a replay of arrivals in ``[start, end)``.

    All windows that the replay has seen in full are replaced, also those of which it has nothing left: what
    a correction empties disappears. Windows at the edges of the range stay as they are.
    """
    inside = seen_in_full(start, end, delay)
    return production.filter(~inside).unionByName(replay.filter(inside))
