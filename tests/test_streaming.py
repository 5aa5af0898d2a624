"""Streams against batch results: lateness, restart, retry, layers, progress."""

import datetime
import os
import threading
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import body, event, frame, hms, kafka_table, registry, silver_table
from salestide import contract as c
from salestide.functions.rules import Rules
from salestide.operators import gold, silver
from salestide.plans import scenario
from salestide.session import use_stream_defaults, workspace
from salestide.sources.files import parquet_stream, read_dq_metrics, read_gold
from salestide.streaming import layers, promote, replay
from salestide.streaming.progress import ProgressLog, state_operators, state_rows
from salestide.streaming.replay import land_slices, replay_slices

SF = "/root/testdata/sf0.001"
BOUNDARY = [
    [("z", "00:20:00", 1.0)],
    [("y", "00:22:00", 1.0)],
    [("le", "00:10:00", 2.0), ("gt", "00:10:00.001", 4.0), ("lt", "00:09:59", 8.0), ("in", "00:11:00", 16.0)],
    [("k", "00:13:00", 32.0), ("kk", "00:12:00", 64.0), ("kkk", "00:11:59", 128.0)],
    [("end", "02:00:00", 0.0)],
]


@pytest.fixture(autouse=True)
def stream_defaults(spark):
    use_stream_defaults(spark)


def boundary_events(spark, batch):
    start = hms("00:00:00")
    return silver_table(spark, [
        event(name, (hms(ts) - start).total_seconds(), amount=amount) for name, ts, amount in batch
    ])


def gold_of(spark, path):
    start = hms("00:00:00").timestamp()
    return {
        int(r.window_start.timestamp() - start) // 60: (r.revenue, r.event_count)
        for r in read_gold(spark, path, view=None).collect()
    }


def test_a_slice_from_one_task_is_landed_in_files_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(replay, "FILE_ROWS", 10)
    table = spark.range(0, 45, 1, 1).selectExpr("id", "id % 2 AS slice")
    assert land_slices(table, "slice", f"{folder}/in") == [0, 1]
    landed = spark.read.parquet(f"{folder}/in")
    assert len(landed.inputFiles()) == 6
    assert sorted(r.id for r in landed.collect()) == list(range(45))


def test_events_of_one_task_are_spread_over_all(spark):
    events = spark.range(0, 1000, 1, 1).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5 AS value"
    )
    events = events.union(events.limit(50))
    spread = scenario.spread(events)
    assert sorted(map(str, spread.collect())) == sorted(map(str, events.collect()))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[0] for r in scenario.spread(events).groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == 4 and max(sizes) < 400


def test_lateness_lags_one_batch_within_one_run(spark, folder):
    """Batches that follow each other without an empty batch in between."""
    for number, batch in enumerate(BOUNDARY):
        boundary_events(spark, batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.01)
    source = parquet_stream(spark, f"{folder}/in", c.SILVER_SCHEMA, max_files_per_trigger=1)
    layout = layers.Layout(folder, "r")
    query = layers.start_gold(silver.dedup_stream(source), layout)
    query.awaitTermination()
    assert gold_of(spark, layout.table("gold")) == {10: (4.0 + 16.0 + 32.0, 3), 20: (2.0, 2)}
    assert dropped(query) == [0, 0, 2, 2, 0, 0]


def test_lateness_in_a_replay_of_slices(spark, folder):
    """Each slice is followed by an empty batch, so the watermark of the slice before applies."""
    slices = [boundary_events(spark, batch).withColumn("slice", F.lit(i)) for i, batch in enumerate(BOUNDARY)]
    table = slices[0]
    for part in slices[1:]:
        table = table.unionByName(part)
    numbers = land_slices(table.repartition(6), "slice", f"{folder}/in")
    layout = layers.Layout(folder, "r")
    replay_slices(
        spark, f"{folder}/in", "slice", numbers,
        lambda events: layers.start_gold(silver.dedup_stream(events), layout), c.SILVER_SCHEMA,
    )
    assert numbers == [0, 1, 2, 3, 4]
    assert gold_of(spark, layout.table("gold")) == {10: (32.0, 1), 20: (2.0, 2)}


def dropped(query):
    return [sum(op.numRowsDroppedByWatermark for op in p.stateOperators[-1:]) for p in query.recentProgress]


def staged(spark):
    root = workspace(spark, "test")
    rows = scenario.replay_sales(scenario.read_events(spark, SF))
    numbers = land_slices(scenario.frames(rows, ("slice",)), "slice", f"{root}/topic")
    return f"{root}/topic", numbers, root


def gold_set(spark, layout):
    rows = read_gold(spark, layout.table("gold"), view=None).collect()
    assert len(rows) == len({(r.window_start, r.region, r.plan_tier) for r in rows})
    return sorted(((r.window_start, r.region, r.plan_tier, round(r.revenue or 0.0, 2), r.event_count) for r in rows), key=repr)


def test_stop_and_restart_equals_an_uninterrupted_run(spark):
    topic, numbers, root = staged(spark)
    schemas = registry(spark)

    def starter(layout):
        return lambda records: layers.start_gold(layers.chain(records, schemas), layout)

    whole, halves = layers.Layout(root, "whole"), layers.Layout(root, "halves")
    replay_slices(spark, topic, "slice", numbers, starter(whole))
    replay_slices(spark, topic, "slice", numbers[:2], starter(halves))
    replay_slices(spark, topic, "slice", numbers[:2], starter(halves), first=1)
    replay_slices(spark, topic, "slice", numbers, starter(halves), first=2)
    assert len(numbers) >= 3
    assert gold_set(spark, whole) == gold_set(spark, halves) != []


def test_a_new_run_replays_from_the_beginning_into_its_own_output(spark):
    topic, numbers, root = staged(spark)
    schemas = registry(spark)
    layouts = [layers.Layout(root, run) for run in ("first", "again")]
    for layout in layouts:
        source = parquet_stream(spark, f"{topic}/slice=*", c.KAFKA_SCHEMA)
        layers.start_gold(layers.chain(source, schemas), layout).awaitTermination()
    assert gold_set(spark, layouts[0]) == gold_set(spark, layouts[1]) != []


def test_one_run_over_everything_equals_the_batch_twin(spark):
    topic, numbers, root = staged(spark)
    layout = layers.Layout(root, "r")
    source = parquet_stream(spark, f"{topic}/slice=*", c.KAFKA_SCHEMA)
    layers.start_gold(layers.chain(source, registry(spark)), layout).awaitTermination()
    events = scenario.replay_sales(scenario.read_events(spark, SF))
    twin = gold.closed_windows(gold.revenue_windows(silver.first_arrival(events)), events)
    twin = sorted(
        ((r.window_start, r.region, r.plan_tier, round(r.revenue or 0.0, 2), r.event_count) for r in twin.collect()),
        key=repr,
    )
    assert gold_set(spark, layout) == twin


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.lists(st.integers(0, 59), min_size=1, max_size=3, unique=True))
def test_cutting_on_time_events_into_slices_changes_nothing(spark, cuts):
    root = workspace(spark, "cut")
    rows = [event(str(i % 50), 60.0 * (i % 50), ing=60.0 * (i % 50), offset=i) for i in range(50)]
    rows.append(event("last", 10_000.0, offset=99))
    number = sum((F.when(F.col("kafka_offset") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    table = silver_table(spark, rows).withColumn("slice", number)
    numbers = land_slices(table, "slice", f"{root}/in")
    layout = layers.Layout(root, "r")
    replay_slices(
        spark, f"{root}/in", "slice", numbers,
        lambda events: layers.start_gold(silver.dedup_stream(events), layout), c.SILVER_SCHEMA,
    )
    events = silver_table(spark, rows)
    twin = gold.closed_windows(gold.revenue_windows(silver.first_arrival(events)), events)
    expected = sorted(((r.window_start, r.region, r.plan_tier, r.revenue, r.event_count) for r in twin.collect()), key=repr)
    assert gold_set(spark, layout) == expected


@pytest.mark.parametrize("salts", [0, 5])
def test_stream_dedup_of_an_id_that_holds_most_rows(spark, folder, salts):
    rows = [event("hot" if i % 3 else str(i), 0.0, offset=i) for i in range(600)]
    silver_table(spark, rows).repartition(4).write.parquet(f"{folder}/in")
    source = parquet_stream(spark, f"{folder}/in", c.SILVER_SCHEMA)
    writer = silver.dedup_stream(source, salts=salts).writeStream.format("parquet")
    query = (
        writer.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out = spark.read.schema(c.SILVER_SCHEMA).parquet(f"{folder}/out")
    assert out.count() == 201
    assert out.filter("event_id = 'hot'").count() == 1


def test_dedup_state_is_dropped_behind_the_watermark(spark):
    topic, numbers, root = staged(spark)
    layout = layers.Layout(root, "r")
    schemas = registry(spark)
    replay_slices(
        spark, topic, "slice", numbers,
        lambda records: layers.start_dq(layers.chain(records, schemas), layout),
    )
    operators = state_operators(spark, layout.checkpoint("dq")).collect()
    assert [r.operatorName for r in operators] == ["dedupeWithinWatermark"]
    assert state_rows(spark, layout.checkpoint("dq")).count() < 20


def test_broken_records_do_not_stop_the_stream(spark, folder):
    values = [frame(body("a", 0.0)), None, b"\x01", frame(b"x"), frame(body("b", 1.0), 9), frame(body("c", 2.0)),
              frame(body("a", 0.0)), frame(body(None, 1.0)), frame(body("z", 7200.0))]
    kafka_table(spark, values).write.parquet(f"{folder}/topic")
    layout = layers.Layout(folder, "r")
    layers.run_layers_once(spark, parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA), registry(spark), layout)
    assert spark.read.schema(c.BRONZE_SCHEMA).parquet(layout.table("bronze")).count() == 9
    rejected = spark.read.parquet(layout.table("quarantine")).orderBy("kafka_offset").collect()
    assert [r.reason for r in rejected] == ["NULL_VALUE", "BAD_FRAME", "BAD_PAYLOAD", "UNKNOWN_SCHEMA", "NO_EVENT_ID"]
    assert bytes(rejected[1].value) == b"\x01"
    assert gold_of(spark, layout.table("gold")) == {0: (2.0, 2)}
    metrics = read_dq_metrics(spark, layout.dq_dir, "r").collect()
    assert [(m.batch_id, m.total_records) for m in metrics] == [(0, 3)]
    assert layers.late_of_run(spark, layout).count() == 0


def test_layers_drop_nothing_after_silver(spark):
    topic, numbers, root = staged(spark)
    layout = layers.Layout(root, "r")
    schemas = registry(spark)
    for last in range(len(numbers)):
        replay_slices(
            spark, topic, "slice", numbers[: last + 1],
            lambda records: layers.start_bronze(records, schemas, layout), first=last,
        )
        layers.start_silver(spark, layout).awaitTermination()
        query = layers.start_gold_from_silver(spark, layout)
        query.awaitTermination()
        assert set(dropped(query)) <= {0}


def test_versions_of_the_contract_through_all_layers(spark, folder):
    values = [frame(body("a", 0.0)), frame(body("b", 1.0, discount=0.5, channel="partner", schema_version=2), 2)]
    kafka_table(spark, values).write.parquet(f"{folder}/topic")
    layout = layers.Layout(folder, "r")
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    layers.start_bronze(source, registry(spark), layout, event=c.EVENT_V2, added_fields=c.ADDED_FIELDS).awaitTermination()
    layers.start_silver(spark, layout, event=c.EVENT_V2).awaitTermination()
    stored = spark.read.schema(c.silver_schema(c.EVENT_V2)).parquet(layout.table("silver"))
    got = {r.event_id: (r.discount, r.channel, r.schema_version) for r in stored.collect()}
    assert got == {"a": (0.0, None, 1), "b": (0.5, "partner", 2)}


def test_stream_gold_is_published_in_few_files(spark, folder):
    topic, numbers, root = staged(spark)
    layout = layers.Layout(root, "r")
    source = parquet_stream(spark, f"{topic}/slice=*", c.KAFKA_SCHEMA)
    layers.start_gold(layers.chain(source, registry(spark)), layout).awaitTermination()
    promote.publish(spark, layout.table("gold"), folder, "v1")
    published = promote.current_gold(spark, folder)
    stream = read_gold(spark, layout.table("gold"), view=None)
    assert published.count() == stream.count() > 0
    assert len(published.inputFiles()) <= len(stream.inputFiles())


def test_streams_take_other_dimensions(spark, folder):
    values = [frame(body("a", 0.0)), frame(body("b", 1.0, currency="EUR")), frame(body("z", 7200.0))]
    kafka_table(spark, values).write.parquet(f"{folder}/topic")
    layout = layers.Layout(folder, "r")
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    layers.start_bronze(source, registry(spark), layout).awaitTermination()
    layers.start_silver(spark, layout).awaitTermination()
    layers.start_gold_from_silver(spark, layout, dims=("currency",)).awaitTermination()
    rows = spark.read.parquet(layout.table("gold")).collect()
    assert sorted((r.currency, r.revenue, r.event_count) for r in rows) == [("EUR", 1.0, 1), ("USD", 1.0, 1)]


def land(spark, folder, values, first=0):
    table = kafka_table(spark, [None] * first + values).filter(F.col("offset") >= first)
    table.coalesce(1).write.mode("append").parquet(f"{folder}/topic")


def test_rows_that_silver_has_not_read_are_not_late_but_lag(spark, folder):
    layout = layers.Layout(folder, "r")
    values = [frame(body("a", 0.0)), frame(body("b", 7200.0)), frame(body("b", 7200.0))]
    land(spark, folder, values)
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    layers.start_bronze(source, registry(spark), layout).awaitTermination()
    layers.start_silver(spark, layout).awaitTermination()
    land(spark, folder, [frame(body("late", 1.0)), frame(body("new", 9000.0)), b"poison"], first=3)
    layers.start_bronze(source, registry(spark), layout).awaitTermination()
    assert layers.late_of_run(spark, layout).count() == 0
    assert [r.lag for r in layers.lag_of_run(spark, layout).collect()] == [3]
    layers.start_silver(spark, layout).awaitTermination()
    assert [r.event_id for r in layers.late_of_run(spark, layout).collect()] == ["late"]
    assert [r.lag for r in layers.lag_of_run(spark, layout).collect()] == [0]
    day = datetime.date(2026, 1, 1)
    bounded = layers.late_of_run(spark, layout, since=day, until=day)
    assert [r.event_id for r in bounded.collect()] == ["late"]
    plan = layers.processed_by_silver(spark, layout, since=day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert layers.late_of_run(spark, layout, since=datetime.date(2026, 1, 2)).count() == 0


def test_records_that_came_before_their_schema_are_recovered_once(spark, folder):
    layout = layers.Layout(folder, "r")
    land(spark, folder, [frame(body("a", 0.0)), frame(body("b", 1.0), 2), frame(body("c", 2.0), 3), b"x"])
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    one, two = [(1, "s", 1, "JSON", "v1")], [(1, "s", 1, "JSON", "v1"), (2, "s", 2, "JSON", "v2")]
    layers.start_bronze(source, lambda: registry(spark, one), layout).awaitTermination()
    assert layers.recovered(spark, layout) is None
    land(spark, folder, [frame(body("d", 3.0), 2)], first=4)
    layers.start_bronze(source, lambda: registry(spark, two), layout).awaitTermination()
    for _ in range(2):
        layers.recover(spark, lambda: registry(spark, two), layout)
    assert [r.event_id for r in layers.recovered(spark, layout).collect()] == ["b"]
    rows = layers.stored_bronze(spark, layout).orderBy("kafka_offset").collect()
    assert [(r.event_id, r.quarantine_reason) for r in rows] == [
        ("a", None), ("b", None), (None, "UNKNOWN_SCHEMA"), (None, "BAD_FRAME"), ("d", None),
    ]
    assert all(str(r.ingest_date) == "2026-01-01" for r in rows)


def test_recovered_rows_behind_the_watermark_are_late(spark, folder):
    layout = layers.Layout(folder, "r")
    one, two = [(1, "s", 1, "JSON", "v1")], [(1, "s", 1, "JSON", "v1"), (2, "s", 2, "JSON", "v2")]

    def late(**dates):
        return sorted(r.event_id for r in layers.late_of_run(spark, layout, **dates).collect())

    land(spark, folder, [frame(body("a", 0.0)), frame(body("old", 1.0), 2), frame(body("new", 7199.0), 2), frame(body("z", 7200.0))])
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    layers.start_bronze(source, lambda: registry(spark, one), layout).awaitTermination()
    layers.start_silver(spark, layout).awaitTermination()
    layers.recover(spark, lambda: registry(spark, two), layout)
    assert late() == []  # silver has yet to read them
    layers.start_silver(spark, layout).awaitTermination()
    day, next_day = datetime.date(2026, 1, 1), datetime.date(2026, 1, 2)
    assert sorted(r.event_id for r in spark.read.parquet(layout.table("silver")).collect()) == ["a", "new", "z"]
    assert late() == late(since=day, until=day) == ["old"]
    assert late(since=next_day) == []


def test_gold_that_drops_rows_of_silver_is_an_error(spark, folder):
    for number, batch in enumerate(BOUNDARY):
        boundary_events(spark, batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.01)
    source = parquet_stream(spark, f"{folder}/in", c.SILVER_SCHEMA, max_files_per_trigger=1)
    query = layers.start_gold(source.withWatermark("event_ts", c.WATERMARK_DELAY), layers.Layout(folder, "r"))
    query.awaitTermination()
    with pytest.raises(RuntimeError, match="dropped"):
        layers.check_gold(query)


def test_a_gate_keeps_violations_out_of_revenue_and_stores_them(spark, folder):
    values = [
        frame(body("a", 0.0)), frame(body("b", 1.0, region="XX")), frame(body("c", 2.0, amount=0.0)),
        frame(body("d", 3.0, plan_tier=None)), frame(body("e", 4.0, ingest_time="2026-01-01T01:00:00Z")),
        frame(body("z", 7200.0)),
    ]
    kafka_table(spark, values).write.parquet(f"{folder}/topic")
    layout = layers.Layout(folder, "r")
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    layers.start_bronze(source, registry(spark), layout).awaitTermination()
    layers.start_silver(spark, layout).awaitTermination()
    layers.start_gold_from_silver(spark, layout, gate=Rules()).awaitTermination()
    layers.start_violations(spark, layout).awaitTermination()
    assert gold_of(spark, layout.table("gold")) == {0: (2.0, 2)}
    rejected = spark.read.parquet(layout.table("violations")).collect()
    assert {r.event_id: r.dq_violation_reason for r in rejected} == {
        "b": "INVALID_DOMAIN", "c": "BAD_AMOUNT", "d": "NULL_REQUIRED", "e": "LATENCY_SLA_BREACH",
    }


def test_sibling_checkpoints_and_chosen_folders():
    layout = layers.Layout("/data", "r", {"gold": "/elsewhere/gold"})
    assert layout.table("gold") == "/elsewhere/gold/run_id=r"
    paths = [layout.checkpoint(name) for name in ("bronze", "silver", "gold", "dq")]
    assert not any(a != b and a.startswith(b) for a in paths for b in paths)


def test_live_queries_run_together_and_stop_together(spark, folder):
    """Starts on an empty topic folder; records arrive in steps, and a schema is registered, while all queries run."""
    os.makedirs(f"{folder}/topic")
    layout = layers.Layout(folder, "live")
    source = parquet_stream(spark, f"{folder}/topic", c.KAFKA_SCHEMA)
    registry(spark, [(1, "s", 1, "JSON", "v1")]).write.parquet(f"{folder}/registry")
    failures = []

    def schemas():
        return spark.read.schema(c.REGISTRY_SCHEMA).parquet(f"{folder}/registry")

    def run():
        try:
            options = layers.Options(event=c.EVENT_V2, added_fields=c.ADDED_FIELDS, gated=True)
            layers.run_layers(spark, source, schemas, layout, "200 milliseconds", options)
        except Exception as error:
            failures.append(error)

    def count(name):
        return spark.read.parquet(layout.table(name)).count()

    thread = threading.Thread(target=run)
    thread.start()
    land(spark, folder, [frame(body("a", 0.0)), b"bad", frame(body("b", 1.0)), frame(body("v", 2.0, region="XX"))])
    names = {f"{name}-live" for name in ("quarantine", "silver", "gold", "dq", "violations")}
    wait_for(lambda: names <= {q.name for q in spark.streams.active}, failures)
    registry(spark, [(2, "s", 2, "JSON", "v2")]).write.mode("append").parquet(f"{folder}/registry")
    land(spark, folder, [frame(body("n", 3.0, discount=0.5), 2)], first=4)
    wait_for(lambda: spark.read.parquet(layout.table("silver")).filter("event_id = 'n' and discount = 0.5").count() == 1, failures)
    for step, late in enumerate((7200.0, 7201.0, 7202.0)):
        land(spark, folder, [frame(body(f"z{step}", late))], first=5 + step)
        wait_for(lambda: count("silver") == 5 + step, failures)
    wait_for(lambda: os.path.isdir(layout.table("gold")) and gold_of(spark, layout.table("gold")) == {0: (3.0, 3)}, failures)
    wait_for(lambda: sum(m.total_records for m in read_dq_metrics(spark, layout.dq_dir, "live").collect()) == 7, failures)
    wait_for(lambda: count("quarantine") == 1 and count("violations") == 1, failures)
    next(q for q in spark.streams.active if q.name == "dq-live").stop()
    thread.join(60)
    assert not thread.is_alive() and spark.streams.active == [] and failures == []


def test_rows_recovered_after_the_stream_started_are_read(spark, folder):
    """While only the empty folder is there, nothing says how large the numbers of later ones are."""
    layout = layers.Layout(folder, run_id="r")
    schema = c.bronze_schema(c.EVENT_V1)
    rows = layers.recovered_stream(spark, layout, c.EVENT_V1).select("kafka_offset")
    query = rows.writeStream.format("memory").queryName("recovered_rows").trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        row = [7 if f.name == "kafka_offset" else None for f in schema]
        path = f"{layout.table('recovered')}/call={time.time_ns()}"
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        spark.createDataFrame([tuple(row)], nullable).write.parquet(path)
        query.processAllAvailable()
        assert [r.kafka_offset for r in spark.table("recovered_rows").collect()] == [7]
    finally:
        query.stop()


def wait_for(condition, failures, seconds=60):
    deadline = time.time() + seconds
    while time.time() < deadline:
        assert not failures, failures
        try:
            if condition():
                return
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "FILE_NOT_EXIST" not in str(error):
                raise
        time.sleep(0.3)
    raise AssertionError("condition not met in time")


def test_progress_is_a_table(spark, folder):
    log = ProgressLog(spark, f"{folder}/progress", flush_every=2)
    spark.streams.addListener(log)
    try:
        for batch in BOUNDARY:
            boundary_events(spark, batch).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            time.sleep(0.01)
        source = parquet_stream(spark, f"{folder}/in", c.SILVER_SCHEMA, max_files_per_trigger=1)
        layers.start_gold(silver.dedup_stream(source), layers.Layout(folder, "r")).awaitTermination()
        time.sleep(2)
    finally:
        spark.streams.removeListener(log)
    log.flush()
    rows = log.read().filter("query = 'gold-r'").orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2, 3, 4, 5]
    assert [r.input_rows for r in rows] == [1, 1, 4, 3, 1, 0]
    assert sum(r.rows_dropped_by_watermark for r in rows) == 4
    assert all(r.batch_ms >= 0 and r.state_rows >= 0 for r in rows)
