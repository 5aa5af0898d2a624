"""Schemas resolved from the registry's versions; versions that are kept and swept."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rows import at, body, frame, kafka_table
from salestide import contract as c
from salestide.operators.decode import accepted
from salestide.sources import resolution
from salestide.streaming import promote, retention

KEYS = [{"name": f.name, "type": "string"} for f in c.EVENT_V1.fields if f.name in c.KEY_FIELDS]
DAY = 86400.0


def record(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [*KEYS, *fields]})


ONE = record({"name": "n", "type": "int"}, {"name": "x", "type": ["null", "string"]})
TWO = record({"name": "n", "type": "long"}, {"name": "x", "type": ["null", "string"]}, {"name": "y", "type": "string", "default": "none"})
THREE = record({"name": "n", "type": "double"}, {"name": "y", "type": "string", "default": "none"}, {"name": "z", "type": "boolean", "default": True})


def test_reader_has_every_field_in_its_widest_type():
    found = resolution.resolve([(3, THREE), (1, ONE), (2, TWO)])
    kinds = {f.name: f.dataType.simpleString() for f in found.reader.fields}
    assert kinds == {k["name"]: "string" for k in KEYS} | {"n": "double", "x": "string", "y": "string", "z": "boolean"}
    assert found.added == {"y": (2, "none"), "z": (3, True)}
    assert found.compatible
    assert [change[:3] for change in found.changes] == [
        (2, "n", "widened"), (2, "y", "added"), (3, "n", "widened"), (3, "z", "added"), (3, "x", "dropped"),
    ]
    assert resolution.resolve([]).reader.fields == []


@pytest.mark.parametrize("text,change", [
    (record({"name": "n", "type": "string"}, {"name": "x", "type": ["null", "string"]}), "retyped"),
    (record({"name": "n", "type": "int"}, {"name": "w", "type": "int"}), "added"),
])
def test_versions_that_cannot_be_read_together(spark, text, change):
    found = resolution.resolve([(1, ONE), (2, text)])
    assert not found.compatible and [c[2] for c in found.changes if not c[5]] == [change]
    rows = [(1, "s", 1, "JSON", ONE), (2, "s", 2, "JSON", text)]
    with pytest.raises(resolution.Incompatible, match=f"version 2: .* {change}"):
        resolution.decode_resolved(kafka_table(spark, [b"x"]), spark.createDataFrame(rows, c.REGISTRY_SCHEMA), "s")


def test_narrowed_restored_and_odd_types():
    narrow = resolution.resolve([(1, TWO), (2, record({"name": "n", "type": "int"}, {"name": "y", "type": "string", "default": "none"}))])
    assert narrow.compatible and ("n", "narrowed") in [c[1:3] for c in narrow.changes]
    again = resolution.resolve([(1, ONE), (2, THREE), (3, TWO)])
    assert ("x", "restored") in [c[1:3] for c in again.changes]
    for kind in (["null", "int", "string"], "duration", ["null"]):
        with pytest.raises(resolution.Incompatible):
            resolution.fields(json.dumps({"fields": [{"name": "a", "type": kind}]}))


def test_a_third_version_is_read_with_no_change_of_code(spark):
    registry = [(1, "s", 1, "JSON", ONE), (2, "s", 2, "JSON", TWO)]
    values = [
        frame(body("a", 0.0, n=1, x="p")), frame(body("b", 1.0, n=2**40, y="q"), 2), frame(body("c", 2.0, n=2.5, z=False), 3),
        frame(body("d", 3.0, n="no number")),
    ]

    def read():
        table = spark.createDataFrame(registry, c.REGISTRY_SCHEMA)
        bronze = resolution.decode_resolved(kafka_table(spark, values), table, "s")
        names = [name for name in ("n", "x", "y", "z") if name in bronze.columns]
        return {r.event_id: tuple(r[name] for name in names) for r in accepted(bronze).collect()}

    assert read() == {"a": (1, "p", "none"), "b": (2**40, None, "q"), "d": (None, None, "none")}
    registry.append((3, "s", 3, "JSON", THREE))
    assert read() == {"a": (1.0, "p", "none", True), "b": (2.0**40, None, "q", True), "c": (2.5, None, None, False), "d": (None, None, "none", True)}
    verdict = resolution.resolve_subject(spark.createDataFrame(registry, c.REGISTRY_SCHEMA), "s").table(spark)
    assert verdict.filter("not forward").count() == 3 and verdict.filter("not backward").count() == 0
    with pytest.raises(ValueError, match="more than 2"):
        resolution.resolve_subject(spark.createDataFrame(registry, c.REGISTRY_SCHEMA), "s", max_versions=2)


def write(spark, folder, run, days, promoted=True):
    rows = [(at(d * DAY), at(d * DAY + 300), "EU", "pro", 1.0, len(run)) for d in days]
    promote.write_version(spark.createDataFrame(rows, c.GOLD_SCHEMA), folder, run)
    if promoted:
        promote.point_to(spark, folder, run)


def left(spark, folder):
    return {(r.run_id, int(r.window_date[-2:])) for r in retention.stored_parts(spark, folder).collect()}


def test_a_sweep_keeps_what_is_named_young_or_open(spark, folder):
    now = timedelta(0)
    write(spark, folder, "a", range(3))
    write(spark, folder, "bb", range(1, 2), promoted=False)
    promote.promote(spark, folder, "bb", "ccc", at(DAY), at(1.5 * DAY))
    everything = left(spark, folder)
    assert retention.sweep(spark, folder) == [] and left(spark, folder) == everything  # all is young
    assert retention.sweep(spark, folder, keep=2, grace=now) and left(spark, folder) == everything - {("bb", 2)}
    with retention.open_reader(spark, folder, "a") as table:
        retention.sweep(spark, folder, grace=now)
        assert table.count() == 3 and ("a", 2) in left(spark, folder)
    marked = retention.mark(spark, folder, grace=now)
    assert {(r.run_id, int(r.window_date[-2:])) for r in marked.filter("not reachable").collect()} == {("a", 2)}
    assert len(retention.sweep(spark, folder, grace=now)) == 1
    assert left(spark, folder) == {("a", 1), ("a", 3), ("ccc", 2)}
    assert {r.event_count for r in promote.current_gold(spark, folder).collect()} == {1, 2}
    assert promote.current_gold(spark, folder).count() == 3
    assert retention.sweep(spark, folder, grace=now) == []
    assert promote.diff_versions(spark, folder, "ccc", "ccc").count() == 0


def test_a_reader_that_never_closed_loses_its_hold(spark, folder):
    write(spark, folder, "a", range(2))
    held = retention.open_reader(spark, folder, "a")
    held.__enter__()
    write(spark, folder, "bb", range(2))
    assert retention.live_versions(spark, folder) == ["a", "bb"]
    assert retention.live_versions(spark, folder, lease=timedelta(0)) == ["bb"]
    assert retention.stored_parts(spark, folder).filter(F.col("run_id") == "a").count() == 2
