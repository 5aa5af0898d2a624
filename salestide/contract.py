"""The data contract: table schemas, value domains and reason codes."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BINARY, INT, LONG, DOUBLE = T.StringType(), T.BinaryType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def table(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns; needs no session."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def extend(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + table(**columns).fields)


# What a Kafka source row looks like in Spark.
KAFKA_SCHEMA = table(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG, timestamp=TIMESTAMP,
    timestampType=INT,
)

# The fields of version 1 of the event contract.
EVENT_V1 = table(
    event_id=STRING, event_time=STRING, ingest_time=STRING, account_id=STRING, user_id=STRING,
    event_type=STRING, plan_tier=STRING, region=STRING, currency=STRING, amount=DOUBLE, source=STRING,
    trace_id=STRING, schema_version=INT,
)

# What decoding itself looks at; any reader schema has to hold these.
KEY_FIELDS = ["event_id", "event_time", "ingest_time", "account_id"]


def narrow(*names: str) -> T.StructType:
    """A reader schema of the key fields and ``names``: the body parser skips the values of all others."""
    return T.StructType([f for f in EVENT_V1.fields if f.name in KEY_FIELDS or f.name in names])


# Version 2 adds optional fields. A reader of both versions uses this superset.
EVENT_V2 = extend(EVENT_V1, discount=DOUBLE, channel=STRING)

# Fields that later contract versions introduced: name -> (first version, reader default).
ADDED_FIELDS = {"discount": (2, 0.0), "channel": (2, None)}

REGISTRY_SCHEMA = table(schema_id=LONG, subject=STRING, version=INT, format=STRING, schema=STRING)

KAFKA_COLUMNS = ["kafka_key", "kafka_ingest_ts", "kafka_partition", "kafka_offset"]


def silver_schema(event: T.StructType) -> T.StructType:
    """The event table for a version of the contract."""
    kafka = table(kafka_key=STRING, kafka_ingest_ts=TIMESTAMP, kafka_partition=INT, kafka_offset=LONG)
    return extend(T.StructType(kafka.fields + event.fields), event_ts=TIMESTAMP, ingest_ts=TIMESTAMP)


def bronze_schema(event: T.StructType) -> T.StructType:
    """All records: event columns where they decode, the raw value, and why a record is no event."""
    return extend(silver_schema(event), value=BINARY, schema_id=LONG, quarantine_reason=STRING)


SILVER_SCHEMA = silver_schema(EVENT_V1)
BRONZE_SCHEMA = bronze_schema(EVENT_V1)

GOLD_SCHEMA = table(
    window_start=TIMESTAMP, window_end=TIMESTAMP, region=STRING, plan_tier=STRING, revenue=DOUBLE,
    event_count=LONG,
)

DQ_METRICS_SCHEMA = table(
    dq_run_ts=TIMESTAMP, batch_id=LONG, total_records=LONG, valid_records_estimate=LONG,
    null_required_fields=LONG, invalid_domain_values=LONG, bad_amounts=LONG, latency_sla_breaches=LONG,
)

DQ_SAMPLE_SCHEMA = extend(SILVER_SCHEMA, dq_violation_reason=STRING)

QUARANTINE_COLUMNS = [
    "reason", "error", "value", "kafka_key", "kafka_partition", "kafka_offset", "kafka_ingest_ts",
]

# Domains, required fields and limits of the data-quality rules.
PLAN_TIERS = ["free", "pro", "enterprise"]
REGIONS = ["NA", "EU", "LATAM", "APAC"]
CURRENCIES = ["USD", "CAD", "EUR"]
REQUIRED_FIELDS = ["event_id", "event_ts", "amount", "region", "plan_tier", "currency", "ingest_ts"]
DOMAINS = {"plan_tier": PLAN_TIERS, "region": REGIONS, "currency": CURRENCIES}
LATENCY_SLA_SECONDS = 300
SAMPLE_CAP = 100
WATERMARK_DELAY = "10 minutes"
WINDOW_LENGTH = "5 minutes"
TRIGGER_INTERVAL = "10 seconds"

# Event types whose amount is money paid back.
REFUND_TYPES = ["refund", "chargeback"]

# Why a record is kept out of the event table, in the order the checks are made.
QUARANTINE_REASONS = {
    "NULL_VALUE": "record has no value",
    "BAD_FRAME": "invalid_confluent_wire_format",
    "UNKNOWN_SCHEMA": "schema id is not registered",
    "BAD_PAYLOAD": "body does not decode with its schema",
    "NO_EVENT_ID": "event_id is missing",
    "BAD_EVENT_TIME": "event_time is missing or not a timestamp",
}
