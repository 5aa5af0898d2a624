"""The wire frame of a record value: a zero byte, a 4-byte big-endian schema id, then the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the frame format.
MAGIC = b"\x00"
HEADER_BYTES = 5
ID_BYTES = 4


def has_frame(value: Column) -> Column:
    """True for a well-formed frame, NULL for a NULL value."""
    magic = F.substring(value, 1, 1) == F.lit(MAGIC)
    return (F.octet_length(value) >= HEADER_BYTES) & magic


def frame_schema_id(value: Column) -> Column:
    """The unsigned 32-bit schema id; only meaningful where :func:`has_frame` holds."""
    return F.conv(F.hex(F.substring(value, 2, ID_BYTES)), 16, 10).cast("bigint")


def frame_body(value: Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def encode_frame(schema_id: Column, body: Column) -> Column:
    """Frame a binary ``body`` under ``schema_id``; NULL if either is NULL."""
    id_bytes = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 2 * ID_BYTES, "0"))
    return F.concat(F.lit(MAGIC), id_bytes, body)
