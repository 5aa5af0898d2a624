"""Operational reports over the event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import latency_seconds
from salestide.session import materialize


def partition_distribution(bronze: DataFrame) -> DataFrame:
    """Records and offset range per topic partition."""
    return bronze.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
    )


def offset_lag(bronze: DataFrame, processed: DataFrame) -> DataFrame:
    """Per partition, how far the last processed offset is behind the last bronze offset.

    ``processed`` holds all records that the next layer has taken, whatever became of them: copies, broken and
    late records as well, or a partition that ends in one would lag for ever. A partition of which nothing
    has been taken lags from its first record on.
    """
    kept = bronze.groupBy("kafka_partition").agg(
        F.max("kafka_offset").alias("latest_offset"), F.min("kafka_offset").alias("first_offset")
    )
    done = processed.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("processed_offset"))
    behind = F.col("latest_offset") - F.coalesce("processed_offset", F.col("first_offset") - 1)
    return kept.join(done, "kafka_partition", "left").withColumn("lag", behind).drop("first_offset")


def quarantine_rate(bronze: DataFrame) -> DataFrame:
    """Quarantined records per reason and their share of all records.

    One pass counts every reason, accepted rows included; the total comes from those few counts.
    """
    counts = bronze.groupBy(F.col("quarantine_reason").alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    listed = counts.agg(
        F.sum("records").alias("total_records"), F.collect_list(F.struct("reason", "records")).alias("counts")
    )
    return (
        listed.select("total_records", F.inline("counts"))
        .filter(F.col("reason").isNotNull())
        .select("reason", "records", "total_records", (F.col("records") / F.col("total_records")).alias("rate"))
    )


def latency_by_window(
    silver: DataFrame, length: str = c.WINDOW_LENGTH, sla_seconds: int = c.LATENCY_SLA_SECONDS
) -> DataFrame:
    """Mean and worst latency and the number of breaches per event-time window."""
    return (
        silver.withColumn("latency_seconds", latency_seconds())
        .groupBy(F.window("event_ts", length))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("latency_seconds").alias("avg_latency_seconds"),
            F.max("latency_seconds").alias("max_latency_seconds"),
            F.count_if(F.col("latency_seconds") > sla_seconds).alias("latency_sla_breaches"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_count",
            "avg_latency_seconds",
            "max_latency_seconds",
            "latency_sla_breaches",
        )
    )


def account_partitions(bronze: DataFrame) -> DataFrame:
    """Per account, the number of topic partitions it was seen in; more than one breaks its order."""
    return bronze.groupBy("account_id").agg(
        F.countDistinct("kafka_partition").alias("partitions"), F.count(F.lit(1)).alias("records")
    )


def account_order(bronze: DataFrame) -> DataFrame:
    """Per account, how many events are older than an earlier one of their partition, and by how much at most.

    Rows are spread by range over (account, partition, offset), so an account of any size is as many tasks as its share
    of the rows. Each range knows the newest event time before a row within itself; what came in earlier ranges is
    carried over from their maxima, of which there is one for each account that a range begins with.
    """
    place = ["account_id", "kafka_partition"]
    rows = bronze.select(*place, "kafka_offset", "event_ts").filter(F.col("event_ts").isNotNull())
    ranges = materialize(
        rows.repartitionByRange(*place, "kafka_offset").withColumn("range", F.spark_partition_id()), "account-ranges"
    )
    within = Window.partitionBy("range", *place).orderBy("kafka_offset").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*place).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    newest = ranges.groupBy("range", *place).agg(F.max("event_ts").alias("newest"))
    carried = newest.select("range", *place, F.max("newest").over(before).alias("carried")).filter("carried is not null")
    carried = carried.toDF("_range", "_account", "_partition", "carried")
    placed = ranges.withColumn("earlier", F.max("event_ts").over(within))
    same = [F.col("range") == F.col("_range"), F.col("account_id").eqNullSafe(F.col("_account"))]
    joined = placed.join(F.broadcast(carried), [*same, F.col("kafka_partition").eqNullSafe(F.col("_partition"))], "left")
    behind = F.unix_micros(F.greatest("earlier", "carried")) - F.unix_micros("event_ts")
    return joined.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(behind > 0).alias("inversions"),
        F.greatest(F.max(behind), F.lit(0)).alias("worst_micros"),
    )
