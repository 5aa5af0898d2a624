"""The schema registry as a table, and its join to records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide.operators.skew import salted_join
from salestide.session import fits_broadcast

# A registry holds one row per schema version. A table above this many rows is not broadcast.
MAX_BROADCAST_SCHEMAS = 10_000
# A decoder of Avro bodies needs every schema when the query is built: one branch each, so few.
MAX_AVRO_SCHEMAS = 200
SALTS = 64

#: A registry, or how to read it again.
Registry = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Schemas:
    """The registry for one query: a row per schema id, without the texts of schemas.

    ``small`` says that the rows have been counted to be few. ``avro`` lists (schema id, schema text) of Avro
    bodies.
    """

    table: DataFrame
    small: bool
    avro: list[tuple[int, str]]


def current(registry: Registry) -> DataFrame:
    """The registry as it is now; a file table lists its files when it is opened, so open it again for each run."""
    return registry() if callable(registry) else registry


def schemas_by_id(registry: DataFrame, subject: str | None = None) -> DataFrame:
    """One row per schema id.

    An id may be registered under several subjects; the join must not multiply records, so the first
    subject and version stand for the id.
    """
    rows = registry if subject is None else registry.filter(F.col("subject") == subject)
    first = Window.partitionBy("schema_id").orderBy("subject", "version")
    return rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def load_schemas(
    registry: Registry,
    subject: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_SCHEMAS,
    max_avro: int = MAX_AVRO_SCHEMAS,
) -> Schemas:
    """What decoding needs of the registry; the same table is joined however many rows it has.

    The driver gets only the texts of Avro schemas, and refuses more than ``max_avro``: decode such topics by
    subject.
    """
    by_id = schemas_by_id(current(registry), subject)
    texts = by_id.filter(F.col("format") == "AVRO").select("schema_id", "schema").limit(max_avro + 1).collect()
    if len(texts) > max_avro:
        raise ValueError(f"more than {max_avro} Avro schemas; pass a subject")
    table = by_id.drop("schema")
    return Schemas(table, fits_broadcast(table, max_broadcast_rows), [(row.schema_id, row.schema) for row in texts])


def join_registry(records: DataFrame, schemas: Schemas, salts: int = SALTS) -> DataFrame:
    """Left-join records to their schema row on ``schema_id``.

    A small registry is broadcast. Otherwise both sides are shuffled on (schema_id, salt): nearly all
    records share a few ids, so the id alone would put them in one task.
    """
    if schemas.small:
        return records.join(F.broadcast(schemas.table), "schema_id", "left")
    return salted_join(records, schemas.table, "schema_id", "left", salts)
