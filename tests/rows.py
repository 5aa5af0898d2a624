"""Small event tables for tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from salestide import contract as c

DAY = datetime(2026, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return DAY + timedelta(seconds=seconds)


def hms(text: str) -> datetime:
    hours, minutes, seconds = text.split(":")
    return at(int(hours) * 3600 + int(minutes) * 60 + float(seconds))


def event(event_id="e", ev=0.0, ing=None, offset=0, **changes) -> dict:
    """One silver row; ``ev`` and ``ing`` are seconds into the test day."""
    ing = ev if ing is None else ing
    row = dict(
        kafka_key="acct_0001", kafka_ingest_ts=at(ing if ing is not False else ev), kafka_partition=0,
        kafka_offset=offset, event_id=event_id, event_time=iso(at(ev)), ingest_time=iso(at(ing or 0)),
        account_id="acct_0001", user_id=None, event_type="renewal", plan_tier="pro", region="NA",
        currency="USD", amount=1.0, source="web", trace_id=None, schema_version=1, event_ts=at(ev),
        ingest_ts=at(ing) if ing is not False else None,
    )
    row.update(changes)
    return row


def iso(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def silver_table(spark, rows: list[dict]):
    data = [tuple(row[name] for name in c.SILVER_SCHEMA.names) for row in rows]
    return spark.createDataFrame(data, c.SILVER_SCHEMA)


def frame(body: bytes, schema_id: int = 1) -> bytes:
    return b"\x00" + schema_id.to_bytes(4, "big") + body


def body(event_id="e", ev=0.0, **changes) -> bytes:
    fields = {name: event(event_id, ev)[name] for name in c.EVENT_V1.names}
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v is not None}).encode()


def kafka_table(spark, values: list[bytes | None], times: list[datetime] | None = None):
    times = times or [at(i) for i in range(len(values))]
    data = [
        (bytearray(b"acct_0001"), None if v is None else bytearray(v), "t", 0, i, ts, 0)
        for i, (v, ts) in enumerate(zip(values, times))
    ]
    return spark.createDataFrame(data, c.KAFKA_SCHEMA)


def registry(spark, rows=None):
    rows = rows or [(1, "s", 1, "JSON", "v1"), (2, "s", 2, "JSON", "v2")]
    return spark.createDataFrame(rows, c.REGISTRY_SCHEMA)
