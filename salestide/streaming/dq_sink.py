"""Per-batch data-quality output, written so that a repeated batch replaces its own files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import Rules
from salestide.operators.quality import METRICS, batch_samples, dq_metrics, dq_violations


def write_dq_batch(
    batch: DataFrame,
    batch_id: int,
    dq_dir: str,
    run_id: str,
    rules: Rules = Rules(),
    cap: int = c.SAMPLE_CAP,
    persist: bool = True,
) -> None:
    """Write metrics and violation samples of one batch to ``.../run_id=<run>/batch_id=<id>``.

    The batch is computed once and kept for the two passes over it. Pass ``persist=False`` if it is a
    plain file scan, where a second pruned scan is cheaper than a copy. An empty batch writes nothing.
    """
    if persist:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counters = dq_metrics(batch, rules).first()
        if counters["total_records"] == 0:
            return
        part = f"run_id={run_id}/batch_id={int(batch_id)}"
        metrics = batch.sparkSession.range(0, 1, 1, 1).select(
            F.current_timestamp().alias("dq_run_ts"),
            F.lit(int(batch_id)).cast("bigint").alias("batch_id"),
            *[F.lit(counters[name]).cast("bigint").alias(name) for name in METRICS],
        )
        metrics.write.mode("overwrite").json(f"{dq_dir}/metrics/{part}")
        samples = batch_samples(dq_violations(batch, rules), cap=cap)
        samples.coalesce(1).write.mode("overwrite").json(f"{dq_dir}/samples/{part}")
    finally:
        if persist:
            batch.unpersist()


def dq_writer(
    dq_dir: str, run_id: str, rules: Rules = Rules(), cap: int = c.SAMPLE_CAP, persist: bool = True
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function for a run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_dq_batch(batch, batch_id, dq_dir, run_id, rules, cap, persist)

    return write
