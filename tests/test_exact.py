"""Exact silver: first arrivals, repeated batches, backlogs cut anyhow, late rows by batch, bitmaps of ids."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rows import at, body, frame, kafka_table, registry
from salestide import contract as c
from salestide.operators import id_index
from salestide.session import use_stream_defaults
from salestide.sources.files import parquet_stream, read_dq_metrics, read_gold
from salestide.streaming import exact, layers

HOUR = 3600.0
# Batches of (id, event second, arrival second).
BATCHES = [
    [("a", 0, 50), ("a", 0, 40), ("b", 10, 41), ("b", 10, 41)],
    [("z", 2 * HOUR, 100), ("a", 0, 101), ("c", 20, 102)],
    [("late", 5, 200), ("late", 5, 201), ("b", 10, 202), ("m", 2 * HOUR - 30, 203), ("z", 2 * HOUR, 204)],
    [("end", 30 * HOUR, 300), ("m", 2 * HOUR - 30, 301)],
    [("late", 30 * HOUR + 1, 400), ("a", 30 * HOUR + 2, 401), ("old", 7, 402)],
]
DELAY = 600.0


@pytest.fixture(autouse=True)
def stream_defaults(spark):
    use_stream_defaults(spark)


def land(spark, folder, batch, first):
    rows = [(frame(body(name, seconds)), at(arrival)) for name, seconds, arrival in batch]
    table = kafka_table(spark, [None] * first + [v for v, _ in rows], [at(0)] * first + [t for _, t in rows])
    table.filter(F.col("offset") >= first).repartition(2).write.mode("append").parquet(f"{folder}/topic")


def bronze(spark, folder, layout):
    """One bronze run for each batch, each noted as a unit, while silver stands still."""
    first = 0
    for batch in BATCHES:
        land(spark, folder, batch, first)
        first += len(batch)
        source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
        layers.start_bronze(source, registry(spark), layout).awaitTermination()
        exact.start_units(spark, layout).awaitTermination()


def by_hand():
    """Silver rows (id, arrival) and late rows as known after each batch, one row after the other."""
    newest, silver, late, known_late = None, {}, [], []
    for number, batch in enumerate(BATCHES):
        mark = None if newest is None else newest - DELAY
        before = dict(silver)
        for name, seconds, arrival in sorted(batch, key=lambda r: r[2]):
            if mark is not None and seconds <= mark:
                late.append((name, arrival))
            elif not any(n == name and (mark is None or ts > mark - DELAY) for (n, _), ts in before.items()) and not any(
                n == name for (n, _) in silver.keys() - before.keys()
            ):
                silver[name, arrival] = seconds
        newest = max([seconds for _, seconds, _ in batch] + ([newest] if newest is not None else []))
        names = {n for n, _ in silver}
        known_late.append({(n, a) for n, a in late if n not in names})
    return set(silver), known_late


def silver_of(spark, layout):
    return {(r.event_id, (r.kafka_ingest_ts - at(0).replace(tzinfo=None)).total_seconds()) for r in exact.stored_silver(spark, layout).collect()}


def late_of(spark, layout, until=None):
    rows = exact.late_rows(spark, layout, until).collect()
    return {(r.event_id, (r.kafka_ingest_ts - at(0).replace(tzinfo=None)).total_seconds()) for r in rows}


def test_rows_by_hand_are_as_meant():
    silver, late = by_hand()
    assert ("a", 40) in silver and ("a", 50) not in silver
    assert late == [set(), set(), {("late", 200), ("late", 201)}, {("late", 200), ("late", 201)}, {("old", 402)}]
    assert ("late", 400) in silver and ("a", 401) in silver


def test_silver_and_late_rows_batch_by_batch(spark, folder):
    layout = layers.Layout(folder, "r")
    bronze(spark, folder, layout)
    assert exact.take_backlog(spark, layout, max_bytes=1, most=2) == [0, 1]
    assert exact.take_backlog(spark, layout, max_bytes=1) == [2, 3, 4]
    silver, late = by_hand()
    assert silver_of(spark, layout) == silver
    assert [late_of(spark, layout, until=n) for n in range(5)] == late
    assert exact.late_rows(spark, layout).count() == len(late[-1])
    assert exact.take_backlog(spark, layout) == []


def test_a_backlog_taken_at_once_equals_batches(spark, folder):
    layout = layers.Layout(folder, "r")
    bronze(spark, folder, layout)
    files = spark.read.parquet(f"{layout.table('units')}/unit=*")
    sizes = [r["s"] for r in files.groupBy(F.input_file_name()).agg(F.sum("bytes").alias("s")).collect()]
    assert exact.take_backlog(spark, layout, max_bytes=2 * max(sizes)) in ([0, 1], [0, 1, 2])
    silver, late = by_hand()
    assert silver_of(spark, layout) == silver
    assert late_of(spark, layout) == late[-1]
    query = exact.start_gold(spark, layout)
    query.awaitTermination()
    layers.check_gold(query)
    assert {r.event_count for r in read_gold(spark, layout.table("gold"), view=None).collect()} == {1, 3}


def test_a_batch_taken_again_changes_nothing(spark, folder):
    layout = layers.Layout(folder, "r")
    bronze(spark, folder, layout)
    exact.take_backlog(spark, layout, max_bytes=1)

    def state():
        late = [late_of(spark, layout, until=n) for n in range(5)]
        index = spark.read.parquet(layout.table("silver_ids")).selectExpr("event_date", "batch_id", "bucket", "hex(bitmap) b")
        return silver_of(spark, layout), exact.stored_silver(spark, layout).count(), late, sorted(map(tuple, index.collect()))

    before = state()
    for number in (4, 2):
        rows = spark.read.parquet(f"{layout.table('admissions')}/number={number}").collect()
        units = {r.unit: (r.late_us, [x.path for x in rows if x.unit == r.unit]) for r in rows}
        exact.take(spark, layout, number, units, int(DELAY * 1e6))
        assert state() == before


def test_an_admission_that_was_not_finished_is_written_again(spark, folder):
    import os

    layout = layers.Layout(folder, "r")
    bronze(spark, folder, layout)
    assert exact.admit(spark, layout, max_bytes=1) == 0
    os.remove(f"{layout.table('admissions')}/number=0/_SUCCESS")
    assert exact.take_backlog(spark, layout) == [0]
    assert silver_of(spark, layout) == by_hand()[0]


def test_all_layers_run_after_run(spark, folder):
    layout = layers.Layout(folder, "r")
    one, two = [(1, "s", 1, "JSON", "v1")], [(1, "s", 1, "JSON", "v1"), (2, "s", 2, "JSON", "v2")]
    kafka_table(spark, [frame(body("a", 0.0)), frame(body("old", 1.0), 2), b"x", frame(body("z", 7200.0))]).write.parquet(f"{folder}/topic")
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    assert exact.run_once(spark, source, lambda: registry(spark, one), layout) == [0]
    kafka_table(spark, [None] * 4 + [frame(body("new", 7201.0, region="XX"))]).filter("offset >= 4").write.mode("append").parquet(f"{folder}/topic")
    assert exact.run_once(spark, source, lambda: registry(spark, two), layout) == [1]
    assert {r.event_id for r in exact.stored_silver(spark, layout).collect()} == {"a", "z", "new"}
    assert [r.event_id for r in exact.late_rows(spark, layout).collect()] == ["old"]
    assert sum(m.total_records for m in read_dq_metrics(spark, layout.dq_dir, "r").collect()) == 3
    assert spark.read.parquet(layout.table("quarantine")).count() == 2  # the early record and the broken one
    assert spark.read.parquet(layout.table("violations")).count() == 1
    assert exact.run_once(spark, source, lambda: registry(spark, two), layout) == []


def test_only_dates_that_may_hold_an_id_are_opened(spark, folder):
    rows = spark.range(3000).selectExpr(
        "string(id) event_id", "timestamp '2026-01-01' + make_interval(0,0,0,int(id % 30),0,0,int(id % 7)) event_ts"
    ).withColumn("event_date", F.to_date("event_ts"))
    rows.write.partitionBy("event_date").parquet(f"{folder}/silver")
    stored = spark.read.schema("event_id string, event_ts timestamp, event_date date").parquet(f"{folder}/silver")
    index = id_index.bitmaps(stored, ["event_date"])
    again = spark.createDataFrame([("31", at(9e6)), ("31", at(9e6)), ("62", at(86400.0 * 2 + 62 % 7)), ("none", at(9e6)), (None, at(1))], "event_id string, event_ts timestamp")
    dates = id_index.meeting(index, "event_date", again)
    assert {"2026-01-02", "2026-01-03"} <= {str(d) for d in dates} and len(dates) <= 4
    found = id_index.reused_ids(again, stored, index)
    assert [r.event_id for r in found.collect()] == ["31"]  # the same id at the same time is a copy
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan and all(f"{day}" in plan or str((day - date(1970, 1, 1)).days) in plan for day in dates)
    assert id_index.meeting(index, "event_date", again.limit(0)) == []
    assert id_index.reused_ids(again.limit(0), stored, index).count() == 0
