"""Query progress as a table."""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from salestide import contract as c
from salestide.session import local_table

PROGRESS_SCHEMA = c.table(
    query=c.STRING, query_id=c.STRING, query_run_id=c.STRING, batch_id=c.LONG, started=c.STRING, input_rows=c.LONG,
    batch_ms=c.LONG, state_rows=c.LONG, state_bytes=c.LONG, rows_dropped_by_watermark=c.LONG, watermark=c.STRING,
)


class ProgressLog(StreamingQueryListener):
    """Append one row per finished batch to a Parquet table, ``flush_every`` rows at a time.

    Add it with ``spark.streams.addListener`` and call :meth:`flush` when the queries have ended.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 100):
        self._spark, self._path, self._flush_every = spark, path, flush_every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(progress_row(event.progress))
            full = len(self._rows) >= self._flush_every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            table = local_table(self._spark, rows, PROGRESS_SCHEMA).coalesce(1)
            table.write.mode("append").parquet(self._path)

    def read(self) -> DataFrame:
        return read_progress(self._spark, self._path)


def progress_row(progress) -> tuple:
    state = progress.stateOperators
    return (
        progress.name,
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.batchDuration,
        sum(operator.numRowsTotal for operator in state),
        sum(operator.memoryUsedBytes for operator in state),
        sum(operator.numRowsDroppedByWatermark for operator in state),
        progress.eventTime.get("watermark") if progress.eventTime else None,
    )


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The keys and values that a stateful operator holds after the last committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def processed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """The input files (``path``) of the batches that a query on a file source has committed.

    Read from the query's checkpoint: the last commit, how far its offset goes in the source's log, and the log.
    The driver gets two numbers; a query that has committed nothing has no files.
    """
    number = F.regexp_extract(F.input_file_name(), r"/(\d+)$", 1).cast("bigint")
    try:
        last = spark.read.text(f"{checkpoint}/commits").select(number.alias("n")).agg(F.max("n")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        return spark.range(0).select(F.lit("").alias("path"))
    lines = spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()[0].rstrip("\n").split("\n")
    offset = lines[2 + source] if len(lines) > 2 + source else "-"
    if offset == "-":  # the source has had nothing yet, or came to the query after its last commit
        return spark.range(0).select(F.lit("").alias("path"))
    reached = json.loads(offset)["logOffset"]
    entry = F.from_json("value", "path string, batchId bigint")
    log = spark.read.text(f"{checkpoint}/sources/{source}").filter(F.col("value").startswith("{")).select(entry.alias("e"))
    return log.filter(F.col("e.batchId") <= reached).select(plain_path(F.col("e.path")).alias("path")).distinct()


def plain_path(path: Column) -> Column:
    """A path as Spark writes it in different places: one slash after ``file:``, escapes resolved."""
    return F.url_decode(F.replace(F.regexp_replace(path, "^file:/+", "file:/"), F.lit("+"), F.lit("%2B")))


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query have dropped behind the watermark, in its recent batches."""
    return sum(op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators)


def store_progress(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Append a row for each recent batch of a query, for runs that end by themselves."""
    rows = [progress_row(progress) for progress in query.recentProgress]
    if rows:
        local_table(spark, rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
