"""Framed records to typed events, with a reason for every record that cannot be one."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide import contract as c
from salestide.functions.frames import encode_frame, frame_body, frame_schema_id, has_frame
from salestide.sources.registry import Registry, Schemas, join_registry, load_schemas

_CORRUPT = "_corrupt"


def check_frames(records: DataFrame) -> DataFrame:
    """Add ``frame_ok`` and, for good frames, ``schema_id`` and ``body``."""
    value = F.col("value")
    return records.withColumn("frame_ok", has_frame(value)).withColumns(
        {
            "schema_id": F.when(F.col("frame_ok"), frame_schema_id(value)),
            "body": F.when(F.col("frame_ok"), frame_body(value)),
        }
    )


def kafka_columns(records: DataFrame) -> DataFrame:
    """The columns of a Kafka source row that later layers keep."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_ingest_ts"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "value",
    )


def parse_times(events: DataFrame) -> DataFrame:
    """Add ``event_ts`` and ``ingest_ts``; text that is no timestamp gives NULL, not an error."""
    return events.withColumns(
        {
            "event_ts": F.try_to_timestamp("event_time"),
            "ingest_ts": F.try_to_timestamp("ingest_time"),
        }
    )


def decode_records(
    records: DataFrame,
    registry: Registry,
    schema: T.StructType = c.EVENT_V1,
    subject: str | None = None,
    added_fields: Mapping[str, tuple[int, object]] | None = None,
) -> DataFrame:
    """Decode Kafka rows to bronze: every record, typed where possible, with ``quarantine_reason``.

    ``schema`` is the reader's schema; a job that needs few fields passes ``contract.narrow``. A field
    named in ``added_fields`` takes its default in records whose writer schema is older than the field.
    """
    schemas = load_schemas(registry, subject)
    framed = check_frames(kafka_columns(records))
    known = join_registry(framed, schemas).withColumnRenamed("version", "writer_version")
    # Generated columns are computed once per record: a filter on them stays above this step instead of
    # being pushed below it together with a second copy of the body parser.
    event = known.select(
        *c.KAFKA_COLUMNS, "value", "frame_ok", "schema_id", "format", "writer_version",
        F.inline_outer(F.array(_body_struct(schemas, schema))),
    )
    event = event.withColumns(_defaults(added_fields or {}))
    decoded = parse_times(event).withColumn("quarantine_reason", _reason())
    return decoded.select(
        *c.KAFKA_COLUMNS, *schema.names, "event_ts", "ingest_ts", "value", "schema_id", "quarantine_reason"
    )


def decode_again(
    bronze: DataFrame,
    registry: Registry,
    schema: T.StructType = c.EVENT_V1,
    subject: str | None = None,
    added_fields: Mapping[str, tuple[int, object]] | None = None,
) -> DataFrame:
    """Records of bronze whose schema id was unknown when they came, and is registered now: bronze rows again.

    They may carry another reason than before; those whose id is still unknown are left out.
    """
    unknown = bronze.filter(F.col("quarantine_reason") == "UNKNOWN_SCHEMA")
    records = unknown.select(
        F.col("kafka_key").cast("binary").alias("key"), "value", F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.col("kafka_ingest_ts").alias("timestamp"),
    )
    again = decode_records(records, registry, schema, subject, added_fields)
    return again.filter(~F.col("quarantine_reason").eqNullSafe("UNKNOWN_SCHEMA"))


def accepted(bronze: DataFrame) -> DataFrame:
    """The event rows of bronze, without the raw value."""
    return bronze.filter(F.col("quarantine_reason").isNull()).drop(
        "value", "schema_id", "quarantine_reason"
    )


def decoded(bronze: DataFrame) -> DataFrame:
    """The records of bronze whose body was read, whether or not they are usable as events."""
    reason = F.col("quarantine_reason")
    return bronze.filter(reason.isNull() | reason.isin("NO_EVENT_ID", "BAD_EVENT_TIME"))


def quarantined(bronze: DataFrame) -> DataFrame:
    """The records of bronze that are no events, with the reason and the raw value."""
    error = F.coalesce(*[
        F.when(F.col("reason") == reason, F.lit(text)) for reason, text in c.QUARANTINE_REASONS.items()
    ])
    return (
        bronze.filter(F.col("quarantine_reason").isNotNull())
        .withColumnRenamed("quarantine_reason", "reason")
        .withColumn("error", error)
        .select(*c.QUARANTINE_COLUMNS)
    )


def encode_records(
    events: DataFrame, schema_id: Column, fields: Sequence[str], topic: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Events as Kafka rows with a framed JSON body, keyed by account; ``keep`` names columns to carry."""
    body = F.to_json(F.struct(*fields)).cast("binary")
    return events.select(
        F.col("account_id").cast("binary").alias("key"),
        encode_frame(schema_id, body).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_ingest_ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )


def _body_struct(schemas: Schemas, schema: T.StructType) -> Column:
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    text = F.when(F.col("format") == "JSON", F.col("body").cast("string"))
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    branches = [_avro_struct(schema_id, written, schema) for schema_id, written in schemas.avro]
    return F.coalesce(*branches, parsed) if branches else parsed


def _avro_struct(schema_id: int, writer_schema: str, schema: T.StructType) -> Column:
    from pyspark.sql.avro.functions import from_avro

    body = F.when(F.col("schema_id") == schema_id, F.col("body"))
    record = from_avro(body, writer_schema, {"mode": "PERMISSIVE"})
    written = set(_avro_fields(writer_schema))
    fields = [
        (record[field.name] if field.name in written else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in schema.fields
    ]
    return F.when(record.isNotNull(), F.struct(*fields, F.lit(None).cast("string").alias(_CORRUPT)))


def _avro_fields(writer_schema: str) -> list[str]:
    return [field["name"] for field in json.loads(writer_schema)["fields"]]


def _defaults(added_fields: Mapping[str, tuple[int, object]]) -> dict[str, Column]:
    return {
        name: F.when(F.col("writer_version") < since, F.lit(default)).otherwise(F.col(name))
        for name, (since, default) in added_fields.items()
    }


def _reason() -> Column:
    no_id = F.col("event_id").isNull()
    undecoded = no_id & F.col("event_time").isNull() & F.col("account_id").isNull()
    return (
        F.when(F.col("value").isNull(), "NULL_VALUE")
        .when(~F.col("frame_ok"), "BAD_FRAME")
        .when(F.col("format").isNull(), "UNKNOWN_SCHEMA")
        .when(no_id & (F.col(_CORRUPT).isNotNull() | undecoded), "BAD_PAYLOAD")
        .when(no_id, "NO_EVENT_ID")
        .when(F.col("event_ts").isNull(), "BAD_EVENT_TIME")
    )
