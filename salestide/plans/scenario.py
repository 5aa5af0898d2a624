"""Sales events, framed records and arrival slices derived from the whole ``events`` table.

The table has no copies, lateness, regions, plans or broken records. They are added by arithmetic on
its ids, in one pass without a shuffle, so that the oracle SQL can add the same ones. The shares (copies, late
events, regions, plans, currencies, sources) are roughly those of the event source, as fixed remainders.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide import contract as c
from salestide.functions.rules import net_amount
from salestide.operators.decode import encode_records
from salestide.session import local_table

EVENTS_DDL = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
TOPIC = "sales.events.v1"
SUBJECT = f"{TOPIC}-value"
V1_ID, V2_ID, UNREGISTERED_ID = 1, 2, 999
SLICE_DAYS = 10
DAY_SECONDS = 86_400
OFFSETS_PER_DAY = 2 * DAY_SECONDS * 1_000_000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events; the stated schema reads its zone-less timestamps as UTC."""
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """The same events over all tasks; a file of few row groups is read by as few, and records are costly to encode."""
    return events.repartition("event_id", "ts", "user_id", "value")


def registry(spark: SparkSession, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    rows = [
        (V1_ID, SUBJECT, 1, "JSON", c.EVENT_V1.simpleString()),
        (V2_ID, SUBJECT, 2, "JSON", c.EVENT_V2.simpleString()),
    ]
    return local_table(spark, [row for row in rows if row[2] in versions], c.REGISTRY_SCHEMA)


def sales(events: DataFrame) -> DataFrame:
    """Two per cent of the events sent twice, five per cent late by up to ten minutes."""
    event_id = F.col("event_id")
    late = F.when(event_id % 20 == 0, _minus_seconds(_lateness(event_id))).otherwise(F.col("ts"))
    return _sales(events, event_id % 50 == 0, late, arrival_gap_seconds=0)


def replay_sales(events: DataFrame, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Copies that arrive two hours later, and events that are eight days late, in arrival slices."""
    event_id = F.col("event_id")
    very_late = event_id % 40 == 7
    late = (
        F.when(very_late, _minus_seconds(F.lit(8 * DAY_SECONDS)))
        .when(event_id % 20 == 0, _minus_seconds(_lateness(event_id)))
        .otherwise(F.col("ts"))
    )
    rows = _sales(events, (event_id % 50 == 0) | very_late, late, arrival_gap_seconds=7200)
    return rows.withColumn("slice", _days(F.col("kafka_ingest_ts"), slice_days).cast("int"))


def reused_sales(events: DataFrame) -> DataFrame:
    """Sales of which some bear the id of another one, with half the number."""
    number = F.col("event_id").cast("bigint")
    reused = F.when(number % 211 == 5, F.floor(number / 2).cast("string")).otherwise(F.col("event_id"))
    return sales(events).withColumn("event_id", reused)


def frames(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sales rows as Kafka rows; every record is well formed and of version 1."""
    return encode_records(rows, F.lit(V1_ID), c.EVENT_V1.names, TOPIC, keep)


def mixed_frames(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sales rows as Kafka rows, a third of them written with version 2 of the contract."""
    event_id = F.col("event_id").cast("bigint")
    v2 = event_id % 3 == 0
    versioned = rows.withColumns(
        {
            "schema_version": F.when(v2, 2).otherwise(1),
            "discount": F.when(v2, event_id % 10 / 10.0),
            "channel": F.when(v2 & (event_id % 2 == 0), "partner"),
        }
    )
    return encode_records(versioned, F.when(v2, V2_ID).otherwise(V1_ID), c.EVENT_V2.names, TOPIC, keep)


def versioned_registry(spark: SparkSession) -> DataFrame:
    """Three versions as records: the second adds two fields, the third one more, widens one and drops one."""
    kinds = {"string": "string", "double": "double", "int": "int"}
    first = [{"name": f.name, "type": ["null", kinds[f.dataType.simpleString()]]} for f in c.EVENT_V1.fields]
    second = [
        *first, {"name": "discount", "type": "double", "default": 0.0}, {"name": "channel", "type": ["null", "string"], "default": None},
    ]
    third = [
        {"name": "schema_version", "type": "long"} if field["name"] == "schema_version" else field
        for field in second if field["name"] != "trace_id"
    ]
    third.append({"name": "quantity", "type": "long", "default": 1})
    texts = [json.dumps({"type": "record", "name": "sale", "fields": fields}) for fields in (first, second, third)]
    return local_table(
        spark, [(10 + n, SUBJECT, n, "JSON", text) for n, text in enumerate(texts, 1)], c.REGISTRY_SCHEMA
    )


def versioned_frames(rows: DataFrame) -> DataFrame:
    """Sales rows as Kafka rows, a third of them written with each of three versions."""
    event_id = F.col("event_id").cast("bigint")
    version = event_id % 3 + 1
    versioned = rows.withColumns(
        {
            "schema_version": version,
            "discount": F.when(version >= 2, event_id % 10 / 10.0),
            "channel": F.when((version >= 2) & (event_id % 2 == 0), "partner"),
            "quantity": F.when(version == 3, event_id % 5 + 3_000_000_000),
            "trace_id": F.when(version < 3, F.col("trace_id")),
        }
    )
    return encode_records(versioned, 10 + version, [*c.EVENT_V2.names, "quantity"], TOPIC)


def poisoned_frames(rows: DataFrame) -> DataFrame:
    """Sales rows as Kafka rows, about three per cent of them broken in one of seven ways."""
    event_id = F.col("event_id").cast("bigint")
    broken = rows.withColumns(
        {
            "number": event_id,
            "event_id": F.when(event_id % 239 != 0, F.col("event_id")),
            "event_time": F.when(event_id % 241 == 0, "not a time").otherwise(F.col("event_time")),
        }
    )
    schema_id = F.when(F.col("number") % 229 == 0, UNREGISTERED_ID).otherwise(V1_ID)
    records = encode_records(broken, schema_id, c.EVENT_V1.names, TOPIC, ("number",))
    number, value = F.col("number"), F.col("value")
    damaged = (
        F.when(number % 211 == 0, F.lit(None))
        .when(number % 223 == 0, F.concat(F.lit(b"\x01"), F.substring(value, 2, 2**31 - 1)))
        .when(number % 227 == 0, F.substring(value, 1, 3))
        .when(number % 233 == 0, F.concat(F.substring(value, 1, 5), F.lit(b"not json")))
        .otherwise(value)
    )
    return records.withColumn("value", damaged).drop("number")


def _sales(events: DataFrame, resent: Column, event_ts: Column, arrival_gap_seconds: int) -> DataFrame:
    event_id, user_id = F.col("event_id"), F.col("user_id")
    copies = F.when(resent, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    slot = (event_id * 13) % 20
    plan = (
        F.when(event_id % 101 == 0, F.lit(None))
        .when(event_id % 103 == 0, "gold")
        .when(slot < 4, "free")
        .when(slot < 17, "pro")
        .otherwise("enterprise")
    )
    region = (
        F.when(event_id % 107 == 0, "XX")
        .when(user_id % 20 < 9, "NA")
        .when(user_id % 20 < 14, "EU")
        .when(user_id % 20 < 18, "LATAM")
        .otherwise("APAC")
    )
    currency = F.when(user_id % 10 < 7, "USD").when(user_id % 10 < 9, "CAD").otherwise("EUR")
    event_type = (
        F.when(F.col("event_type") == "signup", "subscription_created")
        .when(F.col("event_type") == "purchase", "upgrade")
        .when(F.col("event_type") != "error", "renewal")
        .when(event_id % 3 == 0, "chargeback")
        .otherwise("refund")
    )
    amount = (
        F.when(event_id % 109 == 0, 0.0)
        .when(event_id % 113 == 0, F.lit(None))
        .otherwise(net_amount(F.col("sale_type"), F.col("value")))
    )
    source = (
        F.when(event_id % 20 < 9, "web")
        .when(event_id % 20 < 13, "mobile")
        .when(event_id % 20 < 16, "backend")
        .otherwise("billing")
    )
    account = F.concat(F.lit("acct_"), F.lpad(user_id.cast("string"), 4, "0"))
    arrival = F.timestamp_add("SECOND", F.col("copy") * arrival_gap_seconds, F.col("ts"))
    return (
        events.withColumn("copy", F.explode(copies))
        .withColumns({"event_ts": event_ts, "sale_type": event_type})
        .select(
            event_id.cast("string").alias("event_id"),
            _iso("event_ts").alias("event_time"),
            _iso("ts").alias("ingest_time"),
            account.alias("account_id"),
            F.when(event_id % 10 != 3, F.concat(F.lit("user_"), F.lpad(user_id.cast("string"), 5, "0"))).alias(
                "user_id"
            ),
            F.col("sale_type").alias("event_type"),
            plan.alias("plan_tier"),
            region.alias("region"),
            currency.alias("currency"),
            amount.alias("amount"),
            source.alias("source"),
            F.when(event_id % 5 != 0, F.concat(F.lit("trace_"), event_id.cast("string"))).alias("trace_id"),
            F.lit(1).alias("schema_version"),
            "event_ts",
            F.col("ts").alias("ingest_ts"),
            account.alias("kafka_key"),
            arrival.alias("kafka_ingest_ts"),
            (user_id % 3).cast("int").alias("kafka_partition"),
            # Offsets ascend with arrival; like those of a compacted topic they have gaps.
            ((F.unix_micros(arrival) - F.unix_micros(_start())) * 2 + F.col("copy")).alias("kafka_offset"),
            _days(arrival, 3).alias("batch_id"),
        )
    )


def _lateness(event_id: Column) -> Column:
    return 5 + ((event_id % 596) * 7919) % 596


def _minus_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", -seconds, F.col("ts"))


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _days(ts: Column, length: float) -> Column:
    """The number of whole periods of ``length`` days since 2024-01-01."""
    return F.floor((ts.cast("long") - _start().cast("long")) / (length * DAY_SECONDS))


def _start() -> Column:
    return F.lit("2024-01-01").cast("timestamp")
