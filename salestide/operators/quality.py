"""Data-quality flags, counters, violations and capped samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import Rules

# The columns of a metrics row, in order.
METRICS = [
    "total_records", "valid_records_estimate", "null_required_fields", "invalid_domain_values",
    "bad_amounts", "latency_sla_breaches",
]
SAMPLE_SALTS = 64


def dq_flags(events: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add one boolean column per rule."""
    return events.withColumns(rules.flags())


def dq_metrics(events: DataFrame, rules: Rules = Rules(), by: Sequence[str] = ()) -> DataFrame:
    """Counters over all rows, or per group of ``by``, in one aggregation."""
    per_rule = [F.count_if(rule.broken).alias(rule.counter) for rule in rules.listed()]
    everything, valid = F.count(F.lit(1)), F.count_if(~rules.invalid())
    counters = events.groupBy(*by).agg(
        everything.alias("total_records"), valid.alias("valid_records_estimate"), *per_rule
    )
    return counters.select(*by, *METRICS)


def dq_violations(events: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows that break any rule, latency included, with the names of the broken rules."""
    return events.withColumn("dq_violation_reason", rules.reason()).filter("dq_violation_reason <> ''")


def dq_samples(
    violations: DataFrame,
    by: str = "batch_id",
    order: Sequence[str] = ("event_id",),
    cap: int = c.SAMPLE_CAP,
    salts: int = SAMPLE_SALTS,
) -> DataFrame:
    """The first ``cap`` violations of each batch, in a fixed order.

    Two steps: first per (batch, hash bucket), then per batch, so the task of a batch that holds most
    violations receives at most ``cap * salts`` rows.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(salts))
    within_bucket = Window.partitionBy(by, "_bucket").orderBy(*order)
    within_batch = Window.partitionBy(by).orderBy(*order)
    return (
        violations.withColumn("_bucket", bucket)
        .withColumn("_rank", F.row_number().over(within_bucket))
        .filter(F.col("_rank") <= cap)
        .withColumn("_rank", F.row_number().over(within_batch))
        .filter(F.col("_rank") <= cap)
        .drop("_bucket", "_rank")
    )


def batch_samples(
    violations: DataFrame, order: Sequence[str] = ("event_id",), cap: int = c.SAMPLE_CAP
) -> DataFrame:
    """The first ``cap`` violations of a single batch; each task keeps only its own top rows."""
    return violations.orderBy(*order).limit(cap)
