"""Kafka gating, session helpers, job settings, and the shape of the physical plans."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rows import event, silver_table
from salestide import session
from salestide.functions.rules import Rules
from salestide.job import Settings
from salestide.sources import kafka
from salestide.sources.files import read_gold
from salestide.operators import decode, gold
from salestide.plans import catalog
from salestide.streaming import promote
from salestide.streaming.layers import Options

SF = "/root/testdata/sf0.001"
STREAMS = {
    "gold_stream_replay", "gold_layers_replay", "dq_stream_replay", "dq_history", "silver_stream_replay",
    "late_quarantine", "restart_replay", "stream_progress", "dq_retry_replay", "dq_violations_stored",
    "registry_rollout_replay",
}


def has_kafka(spark):
    try:
        spark.readStream.format("kafka").option("subscribe", "t").option("kafka.bootstrap.servers", "h:1").load()
        return True
    except Exception as error:
        return "data source" not in str(error).lower()


def test_kafka_needs_its_package(spark):
    if has_kafka(spark):
        pytest.skip("Spark's Kafka package is on this session")
    calls = [
        lambda: kafka.kafka_stream(spark, "h:1", "t", max_offsets_per_trigger=10, min_partitions=4),
        lambda: kafka.kafka_range(spark, "h:1", "t", {0: 5}, {0: 9}, min_partitions=4),
        lambda: kafka.kafka_time_range(spark, "h:1", "t", 0, 1),
        lambda: kafka.publish_events(silver_table(spark, [event()]), 1, "h:1", "t"),
    ]
    for call in calls:
        with pytest.raises(kafka.KafkaPackageMissing):
            call()


def test_offsets_of_a_range():
    assert kafka._offsets("t", {0: 5, 2: 7}) == '{"t": {"0": 5, "2": 7}}'
    assert kafka._offsets("t", "earliest") == "earliest"


def test_workspace_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.workspace(spark, "x"), session.workspace(spark, "x")
    assert first.startswith(root + "/x-") and first != second


def test_broadcast_bounds(spark):
    df = spark.createDataFrame([("a" * 10,), (None,), ("b" * 10,)], "s string")
    assert session.fits_broadcast(df, 3) and not session.fits_broadcast(df, 2)
    assert session.fits_broadcast(df, 3, max_bytes=20) and not session.fits_broadcast(df, 3, max_bytes=19)
    assert session.fits_broadcast(df.filter("false"), 0)


PLACES = {"DATA_DIR": "file:///shared", "SCHEMA_REGISTRY_TABLE": "file:///shared/schemas"}


def test_settings_from_environment():
    settings = Settings.from_env(PLACES | {"KAFKA_TOPIC": "t", "LATENCY_SLA_SECONDS": "60", "GOLD_DIR": "file:///g"})
    assert (settings.topic, settings.latency_sla_seconds, settings.trigger) == ("t", 60, "10 seconds")
    assert settings.layout().table("gold") == "file:///g/run_id=main"
    assert settings.layout().checkpoint("dq") == "file:///shared/checkpoints/dq/run_id=main"
    assert settings.options() == Options(rules=Rules(latency_sla_seconds=60))


def test_settings_reach_the_queries():
    chosen = {"EVENT_VERSION": "2", "GATE_REVENUE": "true", "DEDUP_SALTS": "4", "DEAD_LETTER_TOPIC": "d"}
    options = Settings.from_env(PLACES | chosen).options()
    assert (options.event, options.added_fields) == (decode.c.EVENT_V2, decode.c.ADDED_FIELDS)
    assert (options.gated, options.salts, options.dead_letters) == (True, 4, ("kafka:29092", "d"))


@pytest.mark.parametrize("wrong", [{"DATA_DIR": "/data"}, {"SCHEMA_REGISTRY_TABLE": ""}, {"EVENT_VERSION": "3"}])
def test_settings_refuse_local_paths_and_unknown_versions(wrong):
    with pytest.raises(ValueError):
        Settings.from_env(PLACES | wrong)


def test_the_job_starts_as_a_script_from_any_folder(folder):
    job = str(Path(entry.__file__).parent / "salestide" / "job.py")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "DATA_DIR")}
    done = subprocess.run([sys.executable, job], cwd=folder, env=env, capture_output=True, text=True)
    assert "set DATA_DIR to a folder" in done.stderr and "ModuleNotFoundError" not in done.stderr


def test_published_records_hold_the_fields_of_the_contract(spark):
    events = silver_table(spark, [event("a")])
    value = kafka.framed_events(events, 1).select(F.expr("cast(substring(value, 6) as string)")).first()[0]
    assert set(json.loads(value)) <= set(decode.c.EVENT_V1.names) and '"event_id":"a"' in value


def test_time_ranges_are_exact(spark):
    rows = spark.range(5).select(F.timestamp_millis(F.col("id") * 1000).alias("timestamp"), "id")
    assert [r.id for r in kafka.in_time_range(rows, 1000, 3000).collect()] == [1, 2]


def test_modules_import_without_a_session():
    root = str(Path(entry.__file__).parent)
    code = "import __spark_entry__ as e, salestide.job; print(len(e.queries()), len(e.oracle_sql()) > 0)"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(entry.queries())), "True"]


@pytest.mark.parametrize("name", sorted(set(catalog.all_queries()) - STREAMS))
def test_plans_have_no_python_and_no_nested_loops(spark, name):
    plan = catalog.all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in plan


def test_gold_reads_prune_columns_and_dates(spark, folder):
    rows = [event(str(i), 3600.0 * i) for i in range(60)]
    path = promote.write_version(gold.revenue_windows(silver_table(spark, rows)), folder, "r")
    stored = read_gold(spark, path, view=None)
    day = stored.filter(F.col("window_date") == F.lit("2026-01-02").cast("date")).select("revenue")
    assert day.count() == 24
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "ReadSchema: struct<revenue:double>" in plan


def test_top_of_gold_is_not_a_full_sort(spark, folder):
    path = promote.write_version(gold.revenue_windows(silver_table(spark, [event()])), folder, "r")
    plan = gold.latest(read_gold(spark, path, view=None))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_reports_read_only_the_columns_they_need(spark):
    plan = catalog.all_queries()["partition_distribution"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in plan


def test_publish_layout_round_trips_through_decode(spark):
    events = silver_table(spark, [event("a", amount=-2.5), event("b", plan_tier=None)])
    records = decode.encode_records(events, F.lit(1), decode.c.EVENT_V1.names, "t")
    assert records.columns == decode.c.KAFKA_SCHEMA.names
    from rows import registry

    back = decode.accepted(decode.decode_records(records, registry(spark)))
    columns = [name for name in events.columns if name != "kafka_key"]
    assert sorted(map(tuple, back.select(columns).collect()), key=repr) == sorted(
        map(tuple, events.select(columns).collect()), key=repr
    )


def test_dead_letters(spark):
    from rows import frame, kafka_table, registry

    bronze = decode.decode_records(kafka_table(spark, [None, b"\x01", frame(b"{")]), registry(spark))
    letters = kafka.dead_letters(decode.quarantined(bronze))
    got = sorted((bytes(r.key).decode(), bytes(r.value).decode()) for r in letters.collect())
    assert got == [
        ("acct_0001", '{"error":"body does not decode with its schema","event":"AAAAAAF7"}'),
        ("acct_0001", '{"error":"invalid_confluent_wire_format","event":"AQ=="}'),
        ("acct_0001", '{"error":"record has no value"}'),
    ]


def test_salted_join_equals_plain_join(spark):
    from salestide.operators.skew import salted_join

    rows = spark.range(500).select(
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("kafka_offset"),
    )
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k bigint, v string")
    for how in ("left", "left_semi", "left_anti", "inner"):
        salted = salted_join(rows, lookup, "k", how, 8)
        plain = rows.join(lookup, "k", how)
        assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
