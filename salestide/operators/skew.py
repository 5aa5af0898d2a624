"""Joins whose large side may have most of its rows on one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salt(column: str, salts: int) -> Column:
    """A bucket in ``[0, salts)`` that depends on the row alone, so a repeated task gives the same one."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def salted_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: str, salts: int, spread_by: str = "kafka_offset"
) -> DataFrame:
    """Join ``rows`` to a ``lookup`` with unique keys by a shuffle on (key, salt).

    Rows of one key go to ``salts`` tasks, by the value of ``spread_by``; each lookup row is repeated
    once per salt. ``how`` must be a join that keeps or drops single left rows.
    """
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = rows.withColumn("_salt", salt(spread_by, salts)).join(repeated.hint("merge"), [key, "_salt"], how)
    return joined.drop("_salt")
