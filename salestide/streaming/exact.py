"""Silver with exact first arrivals, which takes a backlog of bronze in bounded steps and keeps late rows by step.

A *unit* is what one run over bronze (and over recovered rows) has found new: whole bronze batches, with their files. An
*admission* is a row of units up to a number of bytes, written down before it is read; a silver batch is one admission.
Rows are late against the newest event time of the units before their own, not of their silver batch, so it makes no
difference how a backlog is cut. There is no state but the tables: an admission that is taken again replaces its
own partitions, and compares itself with earlier ones only.

An id is known as long as its event time is within the delay of the watermark, as in a streaming deduplication.
Only event dates that are still open are read for that. Late rows need a look at all of silver; bitmaps of ids by
date (``operators.id_index``) say which dates to open.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide import contract as c
from salestide.functions.rules import Rules
from salestide.operators import id_index
from salestide.operators.decode import accepted
from salestide.operators.gold import DIMENSIONS, split_by_rules
from salestide.operators.silver import ARRIVAL_ORDER, first_arrival
from salestide.session import exists, fits_broadcast, folders, local_table, materialize, use_stream_defaults
from salestide.sources.files import parquet_stream
from salestide.sources.registry import Registry
from salestide.streaming import layers
from salestide.streaming.progress import plain_path

# Bytes of bronze files in one silver batch; a unit that is larger is taken alone.
ADMIT_BYTES = 64 << 30
# Units of one admission: each is a branch of the batch's plan.
ADMIT_UNITS = 64
MAX_BROADCAST_IDS = 500_000

_UNIT = c.table(path=c.STRING, bytes=c.LONG, newest_us=c.LONG, unit=c.LONG)
_ADMISSION = c.table(path=c.STRING, unit=c.LONG, late_us=c.LONG, newest_us=c.LONG, number=c.LONG)
_INDEX = c.table(bucket=c.LONG, bitmap=c.BINARY, event_date=c.DATE, batch_id=c.LONG)


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the finished folders ``name=<number>`` below a path; only the last one can be unfinished."""
    found = sorted(int(folder.rsplit("=", 1)[1]) for folder in folders(spark, f"{path}/{name}=*"))
    if found and not exists(spark, f"{path}/{name}={found[-1]}/_SUCCESS"):
        found.pop()
    return found


def start_units(spark: SparkSession, layout: layers.Layout, event: T.StructType = c.EVENT_V1) -> StreamingQuery:
    """Note the files that bronze has committed since the last run, and recovered ones, as the next unit."""

    def noted(rows: DataFrame) -> DataFrame:
        newest = F.when(F.col("quarantine_reason").isNull(), F.unix_micros("event_ts"))
        return rows.select(
            plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("bytes"), newest.alias("newest_us")
        )

    def write(batch: DataFrame, unit: int) -> None:
        files = materialize(batch.groupBy("path", "bytes").agg(F.max("newest_us").alias("newest_us")), "unit")
        if files.isEmpty():  # files without rows
            return
        files.coalesce(1).write.mode("overwrite").parquet(f"{layout.table('units')}/unit={unit}")

    bronze = parquet_stream(spark, layout.table("bronze"), layers.stored_schema(event))
    again = layers.recovered_stream(spark, layout, event)
    writer = noted(bronze).unionByName(noted(again)).writeStream.foreachBatch(write)
    return (
        writer.queryName(f"units-{layout.run_id}").option("checkpointLocation", layout.checkpoint("units"))
        .trigger(availableNow=True).start()
    )


def admit(
    spark: SparkSession, layout: layers.Layout, watermark: str = c.WATERMARK_DELAY, max_bytes: int = ADMIT_BYTES
) -> int | None:
    """Write down which units the next silver batch takes, and from when on their rows are late; None if there are none.

    The driver sees a row for each waiting unit, at most ``ADMIT_UNITS``.
    """
    units, admissions = layout.table("units"), layout.table("admissions")
    done = _numbers(spark, admissions, "number")
    number, last, newest = 0, -1, None
    if done:
        number = done[-1] + 1
        before = spark.read.schema(_ADMISSION).parquet(f"{admissions}/number={done[-1]}")
        last, newest = before.agg(F.max("unit"), F.max("newest_us")).first()
    waiting = [unit for unit in _numbers(spark, units, "unit") if unit > last][:ADMIT_UNITS]
    if not waiting:
        return None
    files = spark.read.schema(_UNIT).option("basePath", units).parquet(*[f"{units}/unit={unit}" for unit in waiting])
    sizes = files.groupBy("unit").agg(F.sum("bytes").alias("bytes"), F.max("newest_us").alias("newest_us")).orderBy("unit").collect()
    delay, taken, total = round(layers.seconds(spark, watermark) * 1_000_000), [], 0
    for row in sizes:
        if taken and total + row["bytes"] > max_bytes:
            break
        total += row["bytes"]
        # Spark's watermarks have whole milliseconds.
        late = None if newest is None else newest // 1000 * 1000 - delay
        newest = max(filter(lambda us: us is not None, (newest, row["newest_us"])), default=None)
        taken.append((row["unit"], late, newest))
    marks = local_table(spark, taken, c.table(unit=c.LONG, late_us=c.LONG, newest_us=c.LONG))
    chosen = files.select("path", "unit").join(F.broadcast(marks), "unit")
    chosen.select("path", "unit", "late_us", "newest_us").coalesce(1).write.mode("overwrite").parquet(f"{admissions}/number={number}")
    return number


def start_silver(
    spark: SparkSession,
    layout: layers.Layout,
    watermark: str = c.WATERMARK_DELAY,
    event: T.StructType = c.EVENT_V1,
) -> StreamingQuery:
    """Take the admissions that have been written since the last run, one silver batch each."""
    delay = round(layers.seconds(spark, watermark) * 1_000_000)
    source = (
        spark.readStream.schema(_ADMISSION).option("maxFilesPerTrigger", 1).parquet(layout.table("admissions"))
    )

    def write(batch: DataFrame, _: int) -> None:
        files = batch.select("number", "unit", "path", "late_us").collect()  # as many as the bound on bytes lets in
        numbers = {row["number"] for row in files}
        for number in sorted(numbers):
            units: dict[int, tuple[int | None, list[str]]] = {}
            for row in files:
                if row["number"] == number:
                    units.setdefault(row["unit"], (row["late_us"], []))[1].append(row["path"])
            take(batch.sparkSession, layout, number, units, delay, event)

    return (
        source.writeStream.foreachBatch(write).queryName(f"silver-{layout.run_id}")
        .option("checkpointLocation", layout.checkpoint("silver")).trigger(availableNow=True).start()
    )


def take(
    spark: SparkSession,
    layout: layers.Layout,
    number: int,
    units: Mapping[int, tuple[int | None, list[str]]],
    delay_us: int,
    event: T.StructType = c.EVENT_V1,
) -> None:
    """Write silver batch ``number``: of each unit (late mark, files) the first arrivals of ids that are not known.

    Taken again, it replaces its own partitions of silver, its index, and its late rows, and nothing else changes.
    """
    parts = [
        accepted(spark.read.schema(c.bronze_schema(event)).parquet(*paths)).withColumns(
            {"_unit": F.lit(unit).cast("bigint"), "_late": F.lit(late).cast("bigint")}
        )
        for unit, (late, paths) in sorted(units.items())
    ]
    events = reduce(DataFrame.unionByName, parts)
    is_late = F.coalesce(F.unix_micros("event_ts") <= F.col("_late"), F.lit(False))
    on_time = events.filter(~is_late)
    firsts = first_arrival(on_time, key=["event_id", "_unit"], order=ARRIVAL_ORDER)
    marks = [late for late, _ in units.values() if late is not None]
    known = _known_ids(spark, layout, number, min(marks) - delay_us) if marks else None
    if len(units) == 1:
        winners = firsts if known is None else firsts.join(known, "event_id", "left_anti")
    else:
        winners = _unit_by_unit(firsts, known, delay_us)
    winners = winners.drop("_unit", "_late")
    dated = winners.withColumns({"event_date": F.to_date("event_ts"), "batch_id": F.lit(number).cast("bigint")})
    _replace(dated.hint("rebalance", "event_date"), layout.table("silver"))
    written = folders(spark, f"{layout.table('silver')}/event_date=*/batch_id={number}")
    if written:
        new = _silver_at(spark, layout, written).select("event_id", "event_date")
        _replace(
            id_index.bitmaps(new, ["event_date"]).withColumn("batch_id", F.lit(number).cast("bigint")).hint("rebalance", "event_date"),
            layout.table("silver_ids"),
        )
        _take_back(spark, layout, number, new)
    _keep_late(spark, layout, number, events.filter(is_late).drop("_unit", "_late"))


def _replace(rows: DataFrame, path: str) -> None:
    """Write the (event date, batch) partitions that ``rows`` has, in place of those that are there."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(path)


def _silver_at(spark: SparkSession, layout: layers.Layout, paths: list[str]) -> DataFrame:
    schema = c.table(event_id=c.STRING, event_ts=c.TIMESTAMP, event_date=c.DATE, batch_id=c.LONG)
    return spark.read.schema(schema).option("basePath", layout.table("silver")).parquet(*paths)


def _date_folders(spark: SparkSession, layout: layers.Layout) -> dict[date, str]:
    """The folder of each event date that silver has."""
    found = folders(spark, f"{layout.table('silver')}/event_date=*")
    names = {path.rsplit("=", 1)[1]: path for path in found}
    return {date.fromisoformat(name): path for name, path in names.items() if not name.startswith("__")}


def _known_ids(spark: SparkSession, layout: layers.Layout, number: int, since_us: int) -> DataFrame | None:
    """The ids of silver batches before ``number`` with event times after a moment, and the last such time of each.

    Only the moment's date and later ones are opened.
    """
    first = (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=since_us)).date()
    opened = [path for day, path in _date_folders(spark, layout).items() if day >= first]
    if not opened:
        return None
    rows = _silver_at(spark, layout, opened).filter((F.col("batch_id") < number) & (F.unix_micros("event_ts") > since_us))
    return rows.groupBy("event_id").agg(F.max(F.unix_micros("event_ts")).alias("_known"))


def _unit_by_unit(firsts: DataFrame, known: DataFrame | None, delay_us: int) -> DataFrame:
    """Of the first arrivals of each id in each unit, those that find it unknown, as if each unit were a batch.

    An id has at most one row for each unit of the admission here, so its rows are folded within a row.
    """
    rows = firsts.withColumn("_known", F.lit(None).cast("bigint")) if known is None else firsts.join(known, "event_id", "left")
    row = F.struct("_unit", "_late", F.unix_micros("event_ts").alias("us"))
    listed = F.sort_array(F.collect_list(row).over(Window.partitionBy("event_id")))
    start = F.struct(F.col("_known").alias("newest"), F.array().cast("array<bigint>").alias("kept"))

    def step(state, row):
        unknown = state["newest"].isNull() | (row["_late"].isNotNull() & (state["newest"] <= row["_late"] - delay_us))
        taken = F.struct(F.greatest(state["newest"], row["us"]).alias("newest"), F.concat(state["kept"], F.array(row["_unit"])).alias("kept"))
        return F.when(unknown, taken).otherwise(state)

    kept = rows.withColumn("_rows", listed).withColumn("_kept", F.aggregate("_rows", start, step)["kept"])
    return kept.filter(F.array_contains("_kept", F.col("_unit"))).drop("_known", "_rows", "_kept")


def _held_by_silver(spark: SparkSession, layout: layers.Layout, number: int, dates: list[date]) -> DataFrame | None:
    opened = [path for day, path in _date_folders(spark, layout).items() if day in set(dates)]
    return _silver_at(spark, layout, opened).filter(F.col("batch_id") <= number).select("event_id") if opened else None


def _keep_late(spark: SparkSession, layout: layers.Layout, number: int, late: DataFrame) -> None:
    """Store the late rows of a batch whose id silver does not have by now; copies of what silver has are no loss."""
    stored = materialize(late, "late-of-batch")
    ids = materialize(stored.select("event_id").distinct(), "late-ids")
    days = [row[0] for row in stored.select(F.to_date("event_ts")).distinct().collect()]
    # First the dates that the rows have themselves, where nearly all copies are; then those whose bitmaps meet the rest.
    held = _held_by_silver(spark, layout, number, days)
    if held is not None:
        ids = materialize(ids.join(held, "event_id", "left_anti"), "late-ids")
    elsewhere = [day for day in _dates_with(spark, layout, ids) if day not in set(days)]
    held = _held_by_silver(spark, layout, number, elsewhere)
    if held is not None:
        ids = materialize(ids.join(held, "event_id", "left_anti"), "late-ids")
    few = F.broadcast(ids) if fits_broadcast(ids, MAX_BROADCAST_IDS) else ids
    kept = materialize(stored.join(few, "event_id", "left_semi"), "late-kept")
    kept.write.mode("overwrite").parquet(f"{layout.table('late')}/batch_id={number}")
    bits = id_index.bitmaps(kept, [])
    bits.coalesce(1).write.mode("overwrite").parquet(f"{layout.table('late_ids')}/batch_id={number}")


def _dates_with(spark: SparkSession, layout: layers.Layout, ids: DataFrame) -> list[date]:
    if not exists(spark, layout.table("silver_ids")):
        return []
    return id_index.meeting(spark.read.schema(_INDEX).parquet(layout.table("silver_ids")), "event_date", ids)


def _take_back(spark: SparkSession, layout: layers.Layout, number: int, new: DataFrame) -> None:
    """Note the ids that came late in an earlier batch and have become silver rows in this one, under a newer time."""
    index = [n for n in _numbers(spark, layout.table("late_ids"), "batch_id") if n < number]
    if not index:
        return
    root = layout.table("late_ids")
    bits = spark.read.schema(c.table(bucket=c.LONG, bitmap=c.BINARY, batch_id=c.LONG)).option("basePath", root).parquet(
        *[f"{root}/batch_id={n}" for n in index]
    )
    met = id_index.meeting(bits, "batch_id", new)
    if not met:
        return
    earlier = _late_at(spark, layout, met, c.table(event_id=c.STRING)).select("event_id").distinct()
    back = earlier.join(new.select("event_id"), "event_id", "left_semi")
    back.coalesce(1).write.mode("overwrite").parquet(f"{layout.table('late_taken')}/batch_id={number}")


def _late_at(spark: SparkSession, layout: layers.Layout, numbers: list[int], schema: T.StructType) -> DataFrame:
    root = layout.table("late")
    paths = [f"{root}/batch_id={n}" for n in numbers]
    return spark.read.schema(c.extend(schema, batch_id=c.LONG)).option("basePath", root).parquet(*paths)


def late_rows(
    spark: SparkSession, layout: layers.Layout, until: int | None = None, event: T.StructType = c.EVENT_V1
) -> DataFrame:
    """Accepted bronze rows that silver has turned away, of its batches so far (up to ``until``), with ``batch_id``.

    What is kept by batch is read; silver itself is not. Rows whose id silver has taken since are left out.
    """
    limit = float("inf") if until is None else until
    numbers = [n for n in _numbers(spark, layout.table("late"), "batch_id") if n <= limit]
    if not numbers:
        return spark.createDataFrame([], c.extend(c.silver_schema(event), batch_id=c.LONG))
    late = _late_at(spark, layout, numbers, c.silver_schema(event))
    root = layout.table("late_taken")
    taken = [n for n in _numbers(spark, root, "batch_id") if n <= limit]
    if not taken:
        return late
    schema = c.table(event_id=c.STRING, batch_id=c.LONG)
    back = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in taken])
    back = back.groupBy("event_id").agg(F.max("batch_id").alias("_taken"))
    return late.join(back, (late["event_id"] == back["event_id"]) & (F.col("_taken") > late["batch_id"]), "left_anti")


def take_backlog(
    spark: SparkSession,
    layout: layers.Layout,
    watermark: str = c.WATERMARK_DELAY,
    event: T.StructType = c.EVENT_V1,
    max_bytes: int = ADMIT_BYTES,
    most: int | None = None,
) -> list[int]:
    """Note what bronze has, and take it into silver in admissions of bounded size (``most`` of them); their numbers.

    One admission is written and taken at a time, so a run that ends in between leaves at most one to be taken again.
    """
    start_units(spark, layout, event).awaitTermination()
    taken: list[int] = []
    if _numbers(spark, layout.table("admissions"), "number"):
        start_silver(spark, layout, watermark, event).awaitTermination()  # what an earlier run may have left
    while most is None or len(taken) < most:
        number = admit(spark, layout, watermark, max_bytes)
        if number is None:
            break
        start_silver(spark, layout, watermark, event).awaitTermination()
        taken.append(number)
    return taken


def stored_silver(spark: SparkSession, layout: layers.Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """Silver with ``event_date`` and ``batch_id``."""
    return spark.read.schema(_stored_schema(event)).parquet(layout.table("silver"))


def _stored_schema(event: T.StructType) -> T.StructType:
    return c.extend(c.silver_schema(event), event_date=c.DATE, batch_id=c.LONG)


def silver_stream(spark: SparkSession, layout: layers.Layout, event: T.StructType = c.EVENT_V1) -> DataFrame:
    """Silver as a stream. Read it while no silver batch is being written: there is no commit log."""
    return parquet_stream(spark, layout.table("silver"), _stored_schema(event)).drop("event_date", "batch_id")


def start_gold(
    spark: SparkSession,
    layout: layers.Layout,
    watermark: str = c.WATERMARK_DELAY,
    dims: tuple[str, ...] = DIMENSIONS,
    gate: Rules | None = None,
    event: T.StructType = c.EVENT_V1,
) -> StreamingQuery:
    """Append the windows that have closed; any number of silver batches may be new."""
    events = silver_stream(spark, layout, event).withWatermark("event_ts", watermark)
    if gate is not None:
        events, _ = split_by_rules(events, gate)
    return layers.start_gold(events.select("event_ts", *dims, "amount"), layout, dims=dims)


def run_once(
    spark: SparkSession,
    records: DataFrame,
    registry: Registry,
    layout: layers.Layout,
    options: layers.Options = layers.Options(),
    max_bytes: int = ADMIT_BYTES,
) -> list[int]:
    """Take everything that is there through bronze, exact silver, gold and data quality, then stop; the silver batches.

    As :func:`layers.run_layers_once`, but for silver; call it again for what comes next. A query that reads
    silver starts after its batches are complete.
    """
    use_stream_defaults(spark)
    layers.start_bronze(records, registry, layout, event=options.event, added_fields=options.added_fields).awaitTermination()
    if not layers.has_rows(spark, layout.table("bronze")):
        return []
    layers.recover(spark, registry, layout, options.event, options.added_fields)
    taken = take_backlog(spark, layout, options.watermark, options.event, max_bytes)
    gate = options.rules if options.gated else None
    silver = silver_stream(spark, layout, options.event)
    queries = [
        start_gold(spark, layout, options.watermark, gate=gate, event=options.event),
        layers.start_dq(silver, layout, None, options.rules, persist=False),
        layers.start_violations(spark, layout, options.rules, event=options.event, silver=silver),
        *layers.after_bronze(spark, layout, None, options),
    ]
    for query in queries:
        query.awaitTermination()
    layers.check_gold(queries[0])
    return taken
