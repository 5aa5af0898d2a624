"""Backfill output in isolated versions, and a pointer table that names the one readers use.

A version is a list of window dates and, for each, the run whose files hold it. So a promotion writes only the
dates it touches and refers to the rest; earlier versions stay whole and can be pointed to again.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.operators.backfill import gold_diff, merge_windows
from salestide.operators.decode import accepted, decode_records
from salestide.operators.gold import revenue_windows, with_window_date
from salestide.operators.silver import first_arrival
from salestide.session import fits_broadcast, materialize
from salestide.sources.files import read_gold
from salestide.sources.registry import Registry

_MANIFEST = c.table(window_date=c.DATE, run_id=c.STRING, rows=c.LONG, a=c.LONG, b=c.LONG)
_DIGESTS = c.table(hour=c.TIMESTAMP, window_start=c.TIMESTAMP, rows=c.LONG, a=c.LONG, b=c.LONG)
# Revenues that agree to so many decimals have one digest; sums in another order differ in the last bits.
DIGEST_DECIMALS = 6
MAX_BROADCAST_WINDOWS = 100_000
_POINTER = c.table(version=c.STRING, seq=c.LONG, promoted_at=c.TIMESTAMP)


class StalePointer(RuntimeError):
    """Another version has been promoted since this promotion read its production."""


def write_version(gold: DataFrame, root: str, run_id: str, kept: DataFrame | None = None) -> str:
    """Write a gold table to a folder of its own; fails if that run has already written one.

    Rows are brought together by date; Spark merges small dates into one task and splits large ones. ``kept``
    lists dates (and their runs) that the version takes over as they are.
    """
    path = f"{root}/versions/run_id={run_id}"
    _note_run(gold.sparkSession, root, run_id)  # young from its first file on
    by_date = with_window_date(gold).hint("rebalance", "window_date")
    by_date.write.mode("errorifexists").partitionBy("window_date").parquet(path)
    written = gold.sparkSession.read.schema(c.extend(c.GOLD_SCHEMA, window_date=c.DATE)).parquet(path)
    dates = _write_digests(written, root, run_id).withColumn("run_id", F.lit(run_id))
    listed = dates if kept is None else dates.unionByName(kept)
    listed.coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifests/run_id={run_id}")
    _note_run(gold.sparkSession, root, run_id)
    return path


def _note_run(spark: SparkSession, root: str, run_id: str) -> None:
    row = spark.range(0, 1, 1, 1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("written_at"))
    row.write.mode("overwrite").parquet(f"{root}/written/id={run_id}")


def written_runs(spark: SparkSession, root: str) -> DataFrame:
    """The runs that have written a version, and when."""
    return spark.read.schema(c.table(run_id=c.STRING, written_at=c.TIMESTAMP)).parquet(f"{root}/written")


def row_digest(rows: DataFrame) -> list[Column]:
    """Two numbers of a gold row that hardly any other row has; a missing value counts as one."""
    fields = [F.col(name) for name in ("window_start", "region", "plan_tier", "event_count")]
    fields.append(F.round("revenue", DIGEST_DECIMALS) + F.lit(0.0))
    told = [part for field in fields for part in (field.isNull(), field)]
    return [F.xxhash64(*told), F.xxhash64(F.lit(1), *told)]


def _joined_digest(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows, digest`` of each group, whatever the order of its rows."""
    return rows.groupBy(*by).agg(F.sum("rows").alias("rows"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def _write_digests(gold: DataFrame, root: str, run_id: str) -> DataFrame:
    """Store digests of stored gold by window and by hour, in folders by date, and return those by date.

    Each level is joined from the one below; gold itself is read once.
    """
    spark = gold.sparkSession
    a, b = row_digest(gold)
    each = gold.select("window_date", F.date_trunc("hour", "window_start").alias("hour"), "window_start", a.alias("a"), b.alias("b"))
    windows = _joined_digest(each.withColumn("rows", F.lit(1).cast("bigint")), ["window_date", "hour", "window_start"])
    base = f"{root}/digests/run_id={run_id}"
    windows.hint("rebalance", "window_date").write.mode("overwrite").partitionBy("window_date").parquet(f"{base}/windows")
    stored = spark.read.schema(c.extend(_DIGESTS, window_date=c.DATE)).parquet(f"{base}/windows")
    hours = _joined_digest(stored, ["window_date", "hour"])
    hours.hint("rebalance", "window_date").write.mode("overwrite").partitionBy("window_date").parquet(f"{base}/hours")
    return _joined_digest(stored, ["window_date"])


def _digests(spark: SparkSession, root: str, dates: list, level: str) -> DataFrame:
    """Digests by hour or window of the given (date, run) pairs; no other date is opened."""
    parts = [f"{root}/digests/run_id={row.run_id}/{level}/window_date={row.window_date}" for row in dates]
    empty = spark.createDataFrame([], _DIGESTS)
    return spark.read.schema(_DIGESTS).parquet(*parts) if parts else empty


def _unequal(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys that one side lacks, or whose digests differ."""
    told = F.struct("rows", "a", "b")
    sides = [side.select(key, told.alias(name)) for side, name in ((left, "l"), (right, "r"))]
    joined = sides[0].join(sides[1], key, "full_outer")
    return joined.filter(~F.col("l").eqNullSafe(F.col("r"))).select(key)


def diff_versions(spark: SparkSession, root: str, production: str, replay: str) -> DataFrame:
    """:func:`gold_diff` of two versions without the rows that are the same.

    Digests are compared from the top: by date in the manifests, then by hour and by window of the dates that differ.
    Gold is read for the differing windows' dates only; dates that both versions take from one run are equal at once.
    """
    sides = {name: manifest(spark, root, name) for name in (production, replay)}
    left, right = sides[production].alias("l"), sides[replay].alias("r")
    told = [F.struct(f"{side}.rows", f"{side}.a", f"{side}.b") for side in "lr"]
    same_run = F.coalesce(F.col("l.run_id") == F.col("r.run_id"), F.lit(False))
    differ = left.join(right, F.col("l.window_date") == F.col("r.window_date"), "full_outer").filter(~same_run & ~told[0].eqNullSafe(told[1]))
    dates = {row[0] for row in differ.select(F.coalesce("l.window_date", "r.window_date")).collect()}
    held = {name: [row for row in listed.collect() if row.window_date in dates] for name, listed in sides.items()}

    def descend(level: str, key: str, within: DataFrame | None) -> DataFrame:
        found = [_digests(spark, root, held[name], level) for name in (production, replay)]
        if within is not None:
            found = [side.join(within, "hour", "left_semi") for side in found]
        return materialize(_unequal(*found, key), f"unequal-{level}")

    windows = descend("windows", "window_start", descend("hours", "hour", None))
    few = F.broadcast(windows) if fits_broadcast(windows, MAX_BROADCAST_WINDOWS) else windows
    gold = [_read_dates(spark, root, held[name]).join(few, "window_start", "left_semi") for name in (production, replay)]
    return gold_diff(*gold).filter("status <> 'same'")


def backfill_gold(
    records: DataFrame,
    registry: Registry,
    root: str,
    run_id: str,
    parameters: Mapping[str, str] | None = None,
) -> str:
    """Decode, deduplicate and aggregate Kafka rows (a full or bounded replay) into an isolated version.

    ``parameters`` says how the rows were chosen (offsets, times, reason) and is kept with the run.
    """
    schema = c.narrow("region", "plan_tier", "amount")
    events = accepted(decode_records(records, registry, schema))
    path = write_version(revenue_windows(first_arrival(events)), root, run_id)
    record_run(records.sparkSession, root, run_id, parameters or {})
    return path


def record_run(spark: SparkSession, root: str, run_id: str, parameters: Mapping[str, str]) -> None:
    """Note the parameters of a run, so that it can be repeated."""
    pairs = [F.lit(str(text)) for pair in parameters.items() for text in pair]
    noted = F.create_map(*pairs).cast("map<string,string>") if pairs else F.lit(None).cast("map<string,string>")
    row = spark.range(0, 1, 1, 1).select(
        F.lit(run_id).alias("run_id"), noted.alias("parameters"), F.current_timestamp().alias("written_at")
    )
    row.write.mode("append").parquet(f"{root}/runs")


def runs(spark: SparkSession, root: str) -> DataFrame:
    schema = "run_id string, parameters map<string,string>, written_at timestamp"
    return spark.read.schema(schema).parquet(f"{root}/runs")


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_POINTER).parquet(f"{root}/pointer")


def pointer(spark: SparkSession, root: str) -> tuple[str | None, int]:
    """The current version and the number of its promotion; (None, 0) before the first."""
    try:
        newest = _pointers(spark, root).agg(F.max_by("version", "seq").alias("version"), F.max("seq").alias("seq")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, 0
    return newest.version, newest.seq


def point_to(spark: SparkSession, root: str, run_id: str, after: int | None = None) -> None:
    """Make a version the current one. Earlier versions stay, so a promotion can be taken back.

    ``after`` is the promotion that the caller has seen last; if there has been another one, nothing changes and
    :class:`StalePointer` is raised. Promotions are numbered, and a number is written once.
    """
    seen = pointer(spark, root)[1] if after is None else after
    row = spark.range(0, 1, 1, 1).select(F.lit(run_id).alias("version"), F.current_timestamp().alias("promoted_at"))
    try:
        row.write.mode("errorifexists").parquet(f"{root}/pointer/seq={seen + 1}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise StalePointer(f"promotion {seen + 1} has been taken; read production again") from error


def current_version(spark: SparkSession, root: str) -> str | None:
    return pointer(spark, root)[0]


def manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The dates of a version and the runs that hold them."""
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/run_id={run_id}")


def read_version(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The gold table of a version; the driver lists its dates, a few hundred for each year."""
    return _read_dates(spark, root, manifest(spark, root, run_id).orderBy("window_date").collect())


def _read_dates(spark: SparkSession, root: str, dates: list) -> DataFrame:
    """The gold of (date, run) pairs."""
    folders = [f"{root}/versions/run_id={row.run_id}/window_date={row.window_date}" for row in dates]
    if not folders:
        return spark.createDataFrame([], c.extend(c.GOLD_SCHEMA, window_date=c.DATE))
    schema = c.extend(c.GOLD_SCHEMA, run_id=c.STRING, window_date=c.DATE)
    stored = spark.read.schema(schema).option("basePath", f"{root}/versions").parquet(*folders)
    return stored.select(*c.GOLD_SCHEMA.names, "window_date")


def current_gold(spark: SparkSession, root: str) -> DataFrame:
    """The gold table that the pointer names."""
    return read_version(spark, root, current_version(spark, root)).drop("window_date")


def replay_report(spark: SparkSession, root: str, replay_run: str) -> DataFrame:
    """What promoting a stored replay would change: gold rows and event counts by kind of difference."""
    diff = gold_diff(current_gold(spark, root), read_version(spark, root, replay_run).drop("window_date"))
    return diff.groupBy("status").agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.sum("events_production").alias("events_production"),
        F.sum("events_replay").alias("events_replay"),
    )


def promote(
    spark: SparkSession, root: str, replay_run: str, run_id: str, start: datetime | str, end: datetime | str
) -> str:
    """Replace the range of a stored replay of arrivals in ``[start, end)`` in production and point readers to it.

    The replay is read from its isolated output, so its events are not computed again. Only dates that the
    range touches are written; of all others the new version keeps production's files. If another promotion
    comes in between, this one is refused. Before the first promotion, production is empty.
    """
    version, seq = pointer(spark, root)
    if version is None:
        empty = spark.createDataFrame([], c.GOLD_SCHEMA)
        replay = read_version(spark, root, replay_run).drop("window_date")
        path = write_version(merge_windows(empty, replay, start, end), root, run_id)
        point_to(spark, root, run_id, after=seq)
        return path
    dates = manifest(spark, root, version)
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    touched = F.col("window_date").between(F.to_date(first), F.to_date(last))
    production = read_version(spark, root, version).filter(touched).drop("window_date")
    replay = read_version(spark, root, replay_run).filter(touched).drop("window_date")
    path = write_version(merge_windows(production, replay, start, end), root, run_id, dates.filter(~touched))
    point_to(spark, root, run_id, after=seq)
    return path


def publish(spark: SparkSession, gold_path: str, root: str, run_id: str) -> str:
    """Make what a stream has written to ``gold_path`` so far the current version, in few files.

    Only files that the stream has committed are read.
    """
    _, seq = pointer(spark, root)
    path = write_version(read_gold(spark, gold_path, view=None).drop("window_date"), root, run_id)
    point_to(spark, root, run_id, after=seq)
    return path
