"""Which files of versions are still of use, and the removal of the rest.

Reachable are the dates, with the runs that hold them, of the versions that the last promotions name, of versions that a
reader has open, and all of runs that were written within a time of grace: theirs may be promoted any moment. What is not
reachable is swept: folders of single dates, and manifests of versions nobody needs. A promotion that is
under way reads production by its pointer, and writes a run that is younger than the grace.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.session import exists, folders, local_table, remove
from salestide.streaming import promote

_READER = c.table(version=c.STRING, opened_at=c.TIMESTAMP)
_PART = c.table(run_id=c.STRING, window_date=c.STRING, path=c.STRING)


@contextmanager
def open_reader(spark: SparkSession, root: str, version: str | None = None) -> Iterator[DataFrame]:
    """A version (the current one) to read while its files are held: a sweep leaves them until the block ends."""
    held = version or promote.current_version(spark, root)
    path = f"{root}/readers/id={uuid.uuid4().hex}"
    row = spark.range(0, 1, 1, 1).select(F.lit(held).alias("version"), F.current_timestamp().alias("opened_at"))
    row.write.parquet(path)
    try:
        yield promote.read_version(spark, root, held).drop("window_date")
    finally:
        remove(spark, path)


def _young(rows: DataFrame, column: str, within: timedelta) -> DataFrame:
    return rows.filter(F.col(column) > F.current_timestamp() - F.expr(f"INTERVAL {int(within.total_seconds())} SECONDS"))


def live_versions(spark: SparkSession, root: str, keep: int = 1, lease: timedelta = timedelta(days=1)) -> list[str]:
    """The versions of the last ``keep`` promotions, and those that readers opened within ``lease`` and still have."""
    found: list[str] = []
    if exists(spark, f"{root}/pointer"):
        pointers = spark.read.schema(c.table(version=c.STRING, seq=c.LONG)).parquet(f"{root}/pointer")
        found += [row.version for row in pointers.orderBy(F.desc("seq")).limit(keep).collect()]
    if folders(spark, f"{root}/readers/id=*"):
        readers = _young(spark.read.schema(_READER).parquet(f"{root}/readers"), "opened_at", lease)
        found += [row.version for row in readers.select("version").distinct().collect()]
    return sorted(set(found))


def stored_parts(spark: SparkSession, root: str) -> DataFrame:
    """The date folders of all runs: ``run_id, window_date, path``; a listing, nothing is opened."""
    found = []
    for path in folders(spark, f"{root}/versions/run_id=*/window_date=*"):
        run, day = path.rsplit("/", 2)[1:]
        found.append((run.split("=", 1)[1], day.split("=", 1)[1], path))
    return local_table(spark, found, _PART)


def mark(
    spark: SparkSession, root: str, keep: int = 1, grace: timedelta = timedelta(days=1), lease: timedelta = timedelta(days=1)
) -> DataFrame:
    """Every stored date of every run: ``run_id, window_date, path, reachable``."""
    manifests = [promote.manifest(spark, root, version) for version in live_versions(spark, root, keep, lease)]
    wanted = spark.createDataFrame([], c.table(run_id=c.STRING, window_date=c.STRING))
    parts = [m.select("run_id", F.col("window_date").cast("string").alias("window_date")) for m in manifests]
    named = reduce(DataFrame.union, parts, wanted).distinct().withColumn("named", F.lit(True))
    stored = stored_parts(spark, root)
    runs = promote.written_runs(spark, root)
    young = _young(runs, "written_at", grace).select("run_id").distinct().withColumn("young", F.lit(True))
    marked = stored.join(named, ["run_id", "window_date"], "left").join(young, "run_id", "left")
    reachable = F.coalesce("named", F.lit(False)) | F.coalesce("young", F.lit(False))
    return marked.select("run_id", "window_date", "path", reachable.alias("reachable"))


def sweep(
    spark: SparkSession, root: str, keep: int = 1, grace: timedelta = timedelta(days=1), lease: timedelta = timedelta(days=1)
) -> list[str]:
    """Remove the date folders that are not reachable, with their digests, and manifests that no one can use; the folders."""
    live = set(live_versions(spark, root, keep, lease))
    marked = mark(spark, root, keep, grace, lease).collect()
    gone = [row for row in marked if not row.reachable]
    for row in gone:
        remove(spark, row.path)
        for level in ("windows", "hours"):
            remove(spark, f"{root}/digests/run_id={row.run_id}/{level}/window_date={row.window_date}")
    young = {row.run_id for row in _young(promote.written_runs(spark, root), "written_at", grace).select("run_id").collect()}
    for path in folders(spark, f"{root}/manifests/run_id=*"):
        if path.rsplit("=", 1)[1] not in live | young:
            remove(spark, path)
    return [row.path for row in gone]
