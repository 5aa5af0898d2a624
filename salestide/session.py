"""Session settings and the shared folder that jobs write their working tables to."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_STREAM_DEFAULTS = {
    # State larger than executor heap stays on local disk; small change logs instead of full uploads.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of an Arrow batch. Spark's own bound is 64 MiB, of which a task holds several times as much while buffers grow.
BATCH_BYTES = 4 * 1024 * 1024
_BROADCAST_BYTES = "spark.sql.autoBroadcastJoinThreshold"
# Bytes of a stored table that Spark broadcasts by itself. Ten MiB, its own bound, can be a million rows of ids.
SMALL_BROADCAST = 1024 * 1024
_local_root: str | None = None
_scratch = threading.local()
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times in the contract are UTC; pin the session to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_stream_defaults(spark: SparkSession) -> SparkSession:
    """Set the state-store options that the job has not chosen itself."""
    chosen = spark.conf.getAll
    for name, value in _STREAM_DEFAULTS.items():
        if name not in chosen:
            spark.conf.set(name, value)
    return use_utc(spark)


def use_small_batches(spark: SparkSession) -> SparkSession:
    """Bound what a task holds outside the heap and in Python of wide rows (texts, sets), unless the job has chosen a bound itself."""
    if _ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
    return spark


@contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Bound what the driver builds and sends to look up rows by ids while the block runs, unless the job has chosen a bound itself."""
    if _BROADCAST_BYTES in spark.conf.getAll:
        yield
        return
    spark.conf.set(_BROADCAST_BYTES, str(SMALL_BROADCAST))
    try:
        yield
    finally:
        spark.conf.unset(_BROADCAST_BYTES)


def workspace(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of this process.
    """
    global _local_root
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="salestide-")
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once and its lineage ends there.

    Within :func:`scratch` the table is removed at the end of the block; else it stays until :func:`discard`.
    """
    spark = df.sparkSession
    path = workspace(spark, label)
    blocks = _blocks()
    if blocks:
        blocks[-1].add(path)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _paths[stored] = path
    return stored


def owner(df: DataFrame, path: str) -> DataFrame:
    """``df``, with which :func:`discard` removes ``path``: for working tables that :func:`materialize` can't write."""
    _paths[df] = path
    return df


def _blocks() -> list[set[str]]:
    """The paths of working tables made in each open block of this thread, innermost last."""
    if not hasattr(_scratch, "blocks"):
        _scratch.blocks = []
    return _scratch.blocks


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Remove the working tables that a block has made when it ends.

    What the block returns must not read them, but for those it passes to the yielded function: these stay, or
    belong to the block around this one. A block that fails removes all of its tables.
    """
    blocks = _blocks()
    blocks.append(set())
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(_paths[df])
        return df

    done = False
    try:
        yield keep
        done = True
    finally:
        made = blocks.pop()
        left = kept if done else set()
        if blocks:
            blocks[-1].update(left)
        for path in made - left:
            remove(spark, path)


def discard(df: DataFrame) -> None:
    """Remove the working table that :func:`materialize` or :func:`owner` returned as ``df``; nothing may read it from then on."""
    path = _paths.pop(df, None)
    if path is not None:
        remove(df.sparkSession, path)
        for made in _blocks():
            made.discard(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles of queries that have ended, whose files otherwise stay until the driver needs memory.

    For jobs of many rounds.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a table inside the plan; unlike a list of rows it starts no Python workers."""
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of text.

    Reads no more than one row beyond the bound. ``df`` should be stored or cheap: it is read again later.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.octet_length(name), F.lit(0)).cast("bigint") for name in texts]
    size = F.sum(reduce(add, lengths, F.lit(0).cast("bigint")))
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path`` and the path, as the JVM has them."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _hadoop(spark, path)
    return files.exists(location)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that match a pattern (``*`` for any name), in order of their paths; a call to the file system, no job."""
    files, location = _hadoop(spark, pattern)
    found = files.globStatus(location) or []
    return sorted(status.getPath().toString() for status in found if status.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all it holds; one that is not there is no error."""
    files, location = _hadoop(spark, path)
    files.delete(location, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder; on file systems with atomic renames all its files appear at once."""
    files, location = _hadoop(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.exists(location) or not files.rename(location, target):
        raise OSError(f"{path} could not be moved to {to}")
