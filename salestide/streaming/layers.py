"""The streaming queries: one chain from records to gold, or stored layers with a query each."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from salestide import contract as c
from salestide.functions.rules import Rules
from salestide.operators.decode import accepted, decode_again, decode_records, quarantined
from salestide.operators.gold import DIMENSIONS, revenue_windows, split_by_rules, with_window_date
from salestide.operators.late import late_rows
from salestide.operators.ops import offset_lag
from salestide.operators.quality import dq_violations
from salestide.operators.silver import STREAM_SALTS, dedup_stream
from salestide.session import fits_broadcast, materialize, remove, rename, use_stream_defaults
from salestide.sources.files import parquet_stream
from salestide.sources.kafka import dead_letters
from salestide.sources.registry import Registry, current
from salestide.streaming.dq_sink import dq_writer
from salestide.streaming.progress import dropped_as_late, plain_path, processed_files

GOLD_FIELDS = (*DIMENSIONS, "amount")
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
MAX_BROADCAST_FILES = 200_000


@dataclass(frozen=True)
class Layout:
    """Folders of one run below a root that all executors share.

    Every run has its own tables and its own checkpoint per query: a new run never meets the commit log
    of an old one, and dropping one checkpoint leaves the others alone.
    """

    root: str
    run_id: str
    folders: Mapping[str, str] = field(default_factory=dict)
    """Folders kept elsewhere than below ``root``: name of the table, ``dq`` or ``checkpoints`` to path."""

    def folder(self, name: str) -> str:
        return self.folders.get(name, f"{self.root}/{name}")

    def table(self, name: str) -> str:
        return f"{self.folder(name)}/run_id={self.run_id}"

    def checkpoint(self, query: str) -> str:
        return f"{self.folder('checkpoints')}/{query}/run_id={self.run_id}"

    @property
    def dq_dir(self) -> str:
        return self.folder("dq")


def start_bronze(
    records: DataFrame,
    registry: Registry,
    layout: Layout,
    trigger: str | None = None,
    event: T.StructType = c.EVENT_V1,
    added_fields: Mapping[str, tuple[int, object]] | None = None,
) -> StreamingQuery:
    """Decode records once and store all of them, quarantined ones included, by arrival date.

    A query knows the schema ids that are registered when it starts. Start it for what is there (no trigger),
    and again for the next records, with a ``registry`` that is read anew each time.
    """
    bronze = decode_records(records, registry, event, added_fields=added_fields)
    writer = bronze.withColumn("ingest_date", F.to_date("kafka_ingest_ts")).writeStream.partitionBy("ingest_date")
    return _to_parquet(writer, layout, "bronze", trigger)


def bronze_stream(spark: SparkSession, layout: Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """Stored bronze as a stream of whole bronze batches."""
    return parquet_stream(spark, layout.table("bronze"), stored_schema(event)).drop("ingest_date")


def stored_schema(event: T.StructType) -> T.StructType:
    """The columns of stored bronze."""
    return c.extend(c.bronze_schema(event), ingest_date=c.DATE)


def recover(
    spark: SparkSession,
    registry: Registry,
    layout: Layout,
    event: T.StructType = c.EVENT_V1,
    added_fields: Mapping[str, tuple[int, object]] | None = None,
    since: date | None = None,
) -> str | None:
    """Decode the records again that came before their schema was registered, and store them as a bronze batch.

    They are written to the table ``recovered``, a folder for each call that finds any, and silver takes them from there
    unless they are behind its watermark by now. Records that an earlier call has recovered are left out. Backfill
    reads them with bronze (:func:`stored_bronze`). ``since`` bounds the arrival dates of bronze that are opened.
    The folder is written by as many tasks as there are, next to the table, and moved there when it is complete.
    """
    bronze = spark.read.schema(stored_schema(event)).parquet(layout.table("bronze"))
    if since is not None:
        bronze = bronze.filter(F.col("ingest_date") >= F.lit(since))
    again = decode_again(bronze, registry, event, added_fields=added_fields)
    earlier = recovered(spark, layout, event)
    if earlier is not None:
        again = again.join(earlier.select("kafka_partition", "kafka_offset"), ["kafka_partition", "kafka_offset"], "left_anti")
    call = f"call={time.time_ns()}"
    staged, path = f"{layout.table('recovered-staging')}/{call}", f"{layout.table('recovered')}/{call}"
    again.select(*c.bronze_schema(event).names).write.parquet(staged)
    if spark.read.schema(c.bronze_schema(event)).parquet(staged).isEmpty():
        remove(spark, staged)
        return None
    rename(spark, staged, path)
    return path


def recovered_stream(spark: SparkSession, layout: Layout, event: T.StructType) -> DataFrame:
    """What :func:`recover` stores, as a stream."""
    schema = c.bronze_schema(event)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{layout.table('recovered')}/call=0")
    # Named, because Spark would take the type of the folders' numbers from those that are there when the stream starts.
    stored = T.StructType([*schema, T.StructField("call", T.LongType())])
    return parquet_stream(spark, layout.table("recovered"), stored).select(*schema.names)


def recovered(spark: SparkSession, layout: Layout, event: T.StructType = c.EVENT_V1) -> DataFrame | None:
    """All rows that :func:`recover` has stored; None before its first call."""
    try:
        return spark.read.schema(c.bronze_schema(event)).parquet(f"{layout.table('recovered')}/call=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_bronze(spark: SparkSession, layout: Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """All records of a run, each once: as recovered where it was, else as it came, with ``ingest_date``."""
    bronze = spark.read.schema(stored_schema(event)).parquet(layout.table("bronze"))
    again = recovered(spark, layout, event)
    if again is None:
        return bronze
    place = ["kafka_partition", "kafka_offset"]
    unknown = F.col("quarantine_reason").eqNullSafe("UNKNOWN_SCHEMA")
    still = bronze.filter(unknown).join(again.select(*place), place, "left_anti").select(*bronze.columns)
    whole = again.withColumn("ingest_date", F.to_date("kafka_ingest_ts"))
    return bronze.filter(~unknown).unionByName(still).unionByName(whole)


def start_quarantine(
    spark: SparkSession, layout: Layout, trigger: str | None = None, event: T.StructType = c.EVENT_V1
) -> StreamingQuery:
    """Store the records of bronze that are no events, with their reason and raw value."""
    writer = quarantined(bronze_stream(spark, layout, event)).writeStream
    return _to_parquet(writer, layout, "quarantine", trigger)


def start_dead_letters(
    spark: SparkSession,
    layout: Layout,
    servers: str,
    topic: str,
    trigger: str | None = None,
    event: T.StructType = c.EVENT_V1,
) -> StreamingQuery:
    """Publish the quarantined records of bronze to a dead-letter topic."""
    letters = dead_letters(quarantined(bronze_stream(spark, layout, event)))
    writer = (
        letters.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .queryName(f"dead-letters-{layout.run_id}")
        .option("checkpointLocation", layout.checkpoint("dead-letters"))
    )
    return _start(writer, trigger)


def start_silver(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = None,
    watermark: str = c.WATERMARK_DELAY,
    salts: int = STREAM_SALTS,
    event: T.StructType = c.EVENT_V1,
) -> StreamingQuery:
    """Deduplicate the accepted rows of whole bronze batches, and of records that have been recovered."""
    events = accepted(bronze_stream(spark, layout, event).unionByName(recovered_stream(spark, layout, event)))
    deduped = dedup_stream(events, watermark, salts=salts).withColumn("event_date", F.to_date("event_ts"))
    writer = deduped.writeStream.partitionBy("event_date")
    return _to_parquet(writer, layout, "silver", trigger)


def silver_stream(spark: SparkSession, layout: Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """Stored silver as a stream of whole silver batches."""
    schema = c.extend(c.silver_schema(event), event_date=c.DATE)
    return parquet_stream(spark, layout.table("silver"), schema).drop("event_date")


def start_gold(
    silver: DataFrame,
    layout: Layout,
    trigger: str | None = None,
    length: str = c.WINDOW_LENGTH,
    dims: tuple[str, ...] = DIMENSIONS,
) -> StreamingQuery:
    """Append the windows that the watermark of ``silver`` has closed.

    The few rows a batch emits are brought together by date and first dimension, so that a batch writes
    a handful of files and not one per state partition.
    """
    gold = with_window_date(revenue_windows(silver, length, dims)).repartition("window_date", *dims[:1])
    writer = gold.writeStream.partitionBy("window_date")
    return _to_parquet(writer, layout, "gold", trigger)


def start_gold_from_silver(
    spark: SparkSession,
    layout: Layout,
    trigger: str | None = None,
    watermark: str = c.WATERMARK_DELAY,
    dims: tuple[str, ...] = DIMENSIONS,
    gate: Rules | None = None,
    event: T.StructType = c.EVENT_V1,
) -> StreamingQuery:
    """Gold from stored silver, under the watermark that silver was made with: one deduplication for all.

    Gold must not find rows late that silver has taken. In scheduled runs every silver batch is followed by
    an empty one, so both queries have the same limit. Live, both limits trail the newest batch, but an empty
    batch of gold between two of silver would put gold's ahead: with a trigger, gold runs no empty batches, and
    a closed window is written with the next silver rows.

    With ``gate``, rows that break a rule are no revenue; :func:`start_violations` keeps them.
    """
    events = silver_stream(spark, layout, event).withWatermark("event_ts", watermark)
    if gate is not None:
        events, _ = split_by_rules(events, gate)
    before = spark.conf.get(_EMPTY_BATCHES)
    spark.conf.set(_EMPTY_BATCHES, "true" if trigger is None else "false")  # a query keeps what it started with
    try:
        return start_gold(events.select("event_ts", *dims, "amount"), layout, trigger, dims=dims)
    finally:
        spark.conf.set(_EMPTY_BATCHES, before)


def start_violations(
    spark: SparkSession,
    layout: Layout,
    rules: Rules = Rules(),
    trigger: str | None = None,
    event: T.StructType = c.EVENT_V1,
    silver: DataFrame | None = None,
) -> StreamingQuery:
    """Store every row of silver (stored, or the given stream) that breaks a rule, latency included, with the broken rules' names."""
    broken = dq_violations(silver_stream(spark, layout, event) if silver is None else silver, rules)
    return _to_parquet(broken.writeStream, layout, "violations", trigger)


def start_dq(
    silver: DataFrame,
    layout: Layout,
    trigger: str | None = None,
    rules: Rules = Rules(),
    cap: int = c.SAMPLE_CAP,
    persist: bool = True,
) -> StreamingQuery:
    """Write metrics and samples of every silver batch."""
    writer = (
        silver.writeStream.foreachBatch(dq_writer(layout.dq_dir, layout.run_id, rules, cap, persist))
        .queryName(f"dq-{layout.run_id}")
        .option("checkpointLocation", layout.checkpoint("dq"))
    )
    return _start(writer, trigger)


def processed_by_silver(
    spark: SparkSession,
    layout: Layout,
    since: date | None = None,
    until: date | None = None,
    event: T.StructType = c.EVENT_V1,
) -> DataFrame:
    """The bronze rows of the batches that silver has committed, whatever became of them.

    ``since`` and ``until`` (both included) bound the arrival dates, and so the files that are opened.
    """
    bronze = spark.read.schema(stored_schema(event)).parquet(layout.table("bronze"))
    if since is not None:
        bronze = bronze.filter(F.col("ingest_date") >= F.lit(since))
    if until is not None:
        bronze = bronze.filter(F.col("ingest_date") <= F.lit(until))
    return _of_files(bronze, processed_files(spark, layout.checkpoint("silver")))


def _of_files(rows: DataFrame, processed: DataFrame) -> DataFrame:
    """The rows of a stored table that lie in the processed files."""
    files = materialize(processed, "processed-files")
    few = F.broadcast(files) if fits_broadcast(files, MAX_BROADCAST_FILES) else files
    of_file = rows.withColumn("_path", plain_path(F.col("_metadata.file_path")))
    return of_file.join(few, of_file["_path"] == few["path"], "left_semi").drop("_path")


def _recovered_by_silver(
    spark: SparkSession, layout: Layout, since: date | None, until: date | None, event: T.StructType
) -> DataFrame | None:
    """The recovered rows of the batches that silver has committed, by arrival date; None before the first call of :func:`recover`."""
    again = recovered(spark, layout, event)
    if again is None:
        return None
    arrived = F.to_date("kafka_ingest_ts")
    if since is not None:
        again = again.filter(arrived >= F.lit(since))
    if until is not None:
        again = again.filter(arrived <= F.lit(until))
    return _of_files(again, processed_files(spark, layout.checkpoint("silver"), source=1))


def late_of_run(
    spark: SparkSession,
    layout: Layout,
    since: date | None = None,
    until: date | None = None,
    event: T.StructType = c.EVENT_V1,
) -> DataFrame:
    """Accepted bronze rows that silver has turned away, of the batches that silver has committed.

    Recovered rows are among them: they have their schema late, and may be behind the watermark by then. Rows that
    silver has yet to read are not late, however far it is behind. With ``since`` or ``until``, only those arrival
    dates of bronze are opened, and of silver the event dates that their rows have.
    """
    bronze = accepted(processed_by_silver(spark, layout, since, until, event)).drop("ingest_date")
    again = _recovered_by_silver(spark, layout, since, until, event)
    if again is not None:
        bronze = bronze.unionByName(accepted(again))
    silver = spark.read.schema(c.extend(c.silver_schema(event), event_date=c.DATE)).parquet(layout.table("silver"))
    if since is not None or until is not None:
        span = bronze.agg(F.to_date(F.min("event_ts")).alias("first_"), F.to_date(F.max("event_ts")).alias("last_")).first()
        silver = silver.filter(F.col("event_date").between(F.lit(span.first_), F.lit(span.last_)))
    return late_rows(bronze, silver)


def lag_of_run(spark: SparkSession, layout: Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """Per partition, how far silver is behind bronze; 0 everywhere once it has read all of it."""
    bronze = spark.read.schema(stored_schema(event)).parquet(layout.table("bronze"))
    return offset_lag(bronze, processed_by_silver(spark, layout, event=event))


def chain(
    records: DataFrame,
    registry: Registry,
    watermark: str = c.WATERMARK_DELAY,
    salts: int = STREAM_SALTS,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Records to deduplicated events within one query, nothing stored in between.

    Spark moves whole rows to the task of their id; name the event ``fields`` that are needed after that
    (``GOLD_FIELDS``) and only those are decoded and moved.
    """
    if fields is None:
        events = accepted(decode_records(records, registry))
    else:
        events = accepted(decode_records(records, registry, c.narrow(*fields)))
        events = events.select("event_id", "event_ts", "kafka_offset", *fields)
    return dedup_stream(events, watermark, salts=salts)


@dataclass(frozen=True)
class Options:
    """What the runners' queries have in common."""

    watermark: str = c.WATERMARK_DELAY
    rules: Rules = Rules()
    salts: int = STREAM_SALTS
    gated: bool = False
    """Whether rows that break a rule are kept out of revenue."""
    event: T.StructType = c.EVENT_V1
    added_fields: Mapping[str, tuple[int, object]] | None = None
    dead_letters: tuple[str, str] | None = None
    """Servers and topic that quarantined records are published to."""


def after_bronze(spark: SparkSession, layout: Layout, trigger: str | None, options: Options) -> list[StreamingQuery]:
    """The queries that read bronze and store what is no event."""
    queries = [start_quarantine(spark, layout, trigger, options.event)]
    if options.dead_letters is not None:
        queries.append(start_dead_letters(spark, layout, *options.dead_letters, trigger, options.event))
    return queries


def _after_silver(spark: SparkSession, layout: Layout, trigger: str | None, options: Options) -> list[StreamingQuery]:
    """The queries that read silver; gold comes first."""
    gate = options.rules if options.gated else None
    silver = silver_stream(spark, layout, options.event)
    return [
        start_gold_from_silver(spark, layout, trigger, options.watermark, gate=gate, event=options.event),
        start_dq(silver, layout, trigger, options.rules, persist=False),
        start_violations(spark, layout, options.rules, trigger, options.event),
    ]


def check_gold(gold: StreamingQuery) -> None:
    """Raise if gold has dropped rows: silver has taken them, so its revenue would be short."""
    dropped = dropped_as_late(gold)
    if dropped:
        raise RuntimeError(f"{gold.name} dropped {dropped} rows of silver as late")


def run_layers_once(
    spark: SparkSession, records: DataFrame, registry: Registry, layout: Layout, options: Options = Options()
) -> None:
    """Take everything that is there through bronze, silver, gold and data quality, then stop.

    A later run continues where this one ended, and reads the registry again if it is given as a function. A
    layer takes all it finds as one batch; for a long history, backfill is the way.
    """
    use_stream_defaults(spark)
    _bronze_run(records, registry, layout, options)
    if has_rows(spark, layout.table("bronze")):
        recover(spark, registry, layout, options.event, options.added_fields)
    start_silver(spark, layout, None, options.watermark, options.salts, options.event).awaitTermination()
    queries = [*_after_silver(spark, layout, None, options), *after_bronze(spark, layout, None, options)]
    for query in queries:
        query.awaitTermination()
    check_gold(queries[0])


def _bronze_run(records: DataFrame, registry: Registry, layout: Layout, options: Options) -> None:
    start_bronze(
        records, registry, layout, event=options.event, added_fields=options.added_fields
    ).awaitTermination()


def run_layers(
    spark: SparkSession,
    records: DataFrame,
    registry: Registry,
    layout: Layout,
    trigger: str = c.TRIGGER_INTERVAL,
    options: Options = Options(),
) -> None:
    """Run all layers until one of their queries stops, then stop the others.

    Bronze takes what is there, run after run at the trigger's interval, and each run opens the registry
    again, so a record that comes after its schema has been registered finds it. When the registry has
    changed, records that came too early (also those that came while a run was starting) are recovered. The
    other queries run throughout. Silver deduplicates; gold and data quality read silver, and gold must find
    none of it late.
    """
    use_stream_defaults(spark)
    pause = seconds(spark, trigger)
    queries: list[StreamingQuery] = []
    seen = None
    try:
        while all(query.isActive for query in queries):
            began = time.monotonic()
            _bronze_run(records, registry, layout, options)
            registered = _registered(registry)
            if registered != seen and has_rows(spark, layout.table("bronze")):
                recover(spark, registry, layout, options.event, options.added_fields)
                seen = registered
            if not queries and has_rows(spark, layout.table("bronze")):
                queries += after_bronze(spark, layout, trigger, options)
                queries.append(start_silver(spark, layout, trigger, options.watermark, options.salts, options.event))
                wait_for_first_batch(queries[-1])
                gold, *others = _after_silver(spark, layout, trigger, options)
                queries += [gold, *others]
            if queries:
                check_gold(gold)
            time.sleep(max(0.0, pause - (time.monotonic() - began)))
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def _registered(registry: Registry) -> tuple:
    """Changes when the registry does; one row, whatever its size."""
    ids = F.xxhash64("schema_id", "subject", "version")
    return tuple(current(registry).agg(F.count(F.lit(1)), F.bit_xor(ids)).first())


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a query has committed rows to a table; its readers must find the table's commit log."""
    try:
        return not spark.read.schema(c.table(kafka_offset=c.LONG)).parquet(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def seconds(spark: SparkSession, interval: str) -> float:
    """The length of an interval such as ``10 minutes``."""
    zero = F.lit(0).cast("timestamp")
    length = F.unix_micros(zero + F.expr(f"INTERVAL {interval}")) - F.unix_micros(zero)
    return spark.range(1).select(length).first()[0] / 1e6


def wait_for_first_batch(query: StreamingQuery, poll_seconds: float = 0.5) -> None:
    """Wait until a query has written a batch, in this run or an earlier one.

    A reader that starts on a table without a commit log lists files by itself from then on; it could
    then see half of a batch, or files of an attempt that failed.
    """
    while query.isActive:
        progress = query.lastProgress
        if progress is not None and (progress.batchId > 0 or progress.numInputRows > 0):
            return
        time.sleep(poll_seconds)


def _to_parquet(writer: DataStreamWriter, layout: Layout, name: str, trigger: str | None) -> StreamingQuery:
    return _start(
        writer.format("parquet")
        .outputMode("append")
        .queryName(f"{name}-{layout.run_id}")
        .option("path", layout.table(name))
        .option("checkpointLocation", layout.checkpoint(name)),
        trigger,
    )


def _start(writer: DataStreamWriter, trigger: str | None) -> StreamingQuery:
    """Without a trigger interval: take what is available now and stop."""
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.start()
