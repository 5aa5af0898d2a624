"""Rows that never became silver rows because the watermark had passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.session import fits_broadcast, materialize

MAX_BROADCAST_IDS = 500_000


def late_ids(bronze: DataFrame, silver: DataFrame, key: str = "event_id") -> DataFrame:
    """The distinct keys of bronze that silver does not have.

    Only keys are shuffled, and copies of a key are collapsed before the shuffle.
    """
    return bronze.select(key).distinct().join(silver.select(key), key, "left_anti")


def late_rows(
    bronze: DataFrame, silver: DataFrame, key: str = "event_id", max_broadcast_ids: int = MAX_BROADCAST_IDS
) -> DataFrame:
    """All bronze rows whose key silver does not have; both must end at the same committed batch.

    The late keys are written out and counted first. As long as they are few, the wide bronze rows are
    filtered in place by a broadcast; beyond the bounds both sides are shuffled on the key, and Spark splits
    a key that holds very many rows at run time.
    """
    ids = materialize(late_ids(bronze, silver, key), "late-ids")
    few = F.broadcast(ids) if fits_broadcast(ids, max_broadcast_ids) else ids
    return bronze.join(few, key, "left_semi")


def late_summary(late: DataFrame, by: str = "batch_id") -> DataFrame:
    """Late rows and distinct late keys per batch."""
    return late.groupBy(by).agg(
        F.count(F.lit(1)).alias("late_rows"), F.countDistinct("event_id").alias("late_ids")
    )
