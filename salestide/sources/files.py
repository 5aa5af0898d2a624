"""Tables in files: bronze and silver streams, gold for readers, data-quality outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide import contract as c


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    base_path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A directory of Parquet files as an unbounded table.

    Leave the file cap unset when the files of one upstream batch must be read together: a cap lets the
    watermark advance between them, and the later ones are then dropped as late.
    """
    reader = spark.readStream.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_gold(spark: SparkSession, path: str, view: str | None = "revenue_5m") -> DataFrame:
    """The gold table, through the sink's commit log, and as a temp view for ad-hoc SQL."""
    gold = spark.read.schema(c.extend(c.GOLD_SCHEMA, window_date=c.DATE)).parquet(path)
    if view is not None:
        gold.createOrReplaceTempView(view)
    return gold


def read_dq_metrics(spark: SparkSession, dq_dir: str, run_id: str) -> DataFrame:
    """Metrics of all batches of a run, one row per batch."""
    schema = c.extend(c.DQ_METRICS_SCHEMA, run_id=c.STRING)
    path = f"{dq_dir}/metrics/run_id={run_id}"
    return spark.read.schema(schema).option("basePath", f"{dq_dir}/metrics").json(path)


def read_dq_samples(
    spark: SparkSession, dq_dir: str, run_id: str, schema: T.StructType = c.DQ_SAMPLE_SCHEMA
) -> DataFrame:
    """Violation samples of all batches of a run.

    The schema is always given: the folder of a clean batch holds no row to infer one from.
    """
    path = f"{dq_dir}/samples/run_id={run_id}"
    return (
        spark.read.schema(c.extend(schema, run_id=c.STRING, batch_id=c.LONG))
        .option("basePath", f"{dq_dir}/samples")
        .json(path)
    )


def dq_history(spark: SparkSession, dq_dir: str, run_id: str) -> DataFrame:
    """Per batch of a run: its metrics and how many sample rows were kept."""
    kept = (
        read_dq_samples(spark, dq_dir, run_id)
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("sample_rows"))
    )
    return (
        read_dq_metrics(spark, dq_dir, run_id)
        .join(kept, "batch_id", "left")
        .withColumn("sample_rows", F.coalesce("sample_rows", F.lit(0).cast("bigint")))
    )
