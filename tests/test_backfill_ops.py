import pytest
from pyspark.sql import functions as F

from rows import at, body, event, frame, kafka_table, registry, silver_table
from salestide.operators import backfill, gold, ops, silver
from salestide.streaming import promote


def sold(spark, rows):
    return gold.revenue_windows(silver_table(spark, rows))


PRODUCTION = [
    event("a", 0.0), event("a2", 0.0), event("b", 0.0, region=None), event("c", 400.0), event("d", 800.0),
    event("n", 400.0, region="EU", amount=None),
]
REPLAY = [
    event("a", 0.0), event("b", 0.0, region=None), event("e", 0.0, region="APAC"),
    event("n", 400.0, region="EU", amount=None), event("c", 400.0),
]


def test_diff_matches_null_keys(spark):
    diff = backfill.gold_diff(sold(spark, PRODUCTION), sold(spark, REPLAY)).collect()
    got = {(int(r.window_start.timestamp()) - int(at(0).timestamp()), r.region): r.status for r in diff}
    assert got == {
        (0, "NA"): "changed", (0, None): "same", (0, "APAC"): "only_replay", (300, "NA"): "same",
        (600, "NA"): "only_production", (300, "EU"): "same",
    }


def test_diff_sees_revenue_that_turned_null(spark):
    left, right = sold(spark, [event("a")]), sold(spark, [event("a", amount=None)])
    assert backfill.gold_diff(left, right).first().status == "changed"
    assert backfill.gold_diff(right, left).first().status == "changed"


def test_diff_shuffles_on_the_keys(spark):
    diff = backfill.gold_diff(sold(spark, PRODUCTION), sold(spark, REPLAY))
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_totals(spark):
    rows = {r.side: r for r in backfill.gold_totals(sold(spark, PRODUCTION), sold(spark, REPLAY)).collect()}
    assert (rows["production"].gold_rows, rows["production"].event_count, rows["production"].revenue) == (5, 6, 5.0)
    assert (rows["replay"].gold_rows, rows["replay"].event_count, rows["replay"].revenue) == (5, 5, 4.0)


SPAN = at(0), at(900 + 600)  # three windows and the watermark delay


def test_merge_replaces_the_replayed_range(spark):
    """The window at ten minutes, of which the replay has nothing left, goes; the one beyond the range stays."""
    beyond = event("far", 5000.0)
    merged = backfill.merge_windows(sold(spark, [*PRODUCTION, beyond]), sold(spark, REPLAY), *SPAN)
    got = sorted((int(r.window_start.timestamp()) - int(at(0).timestamp()), r.region or "", r.event_count) for r in merged.collect())
    assert got == [(0, "", 1), (0, "APAC", 1), (0, "NA", 1), (300, "EU", 1), (300, "NA", 1), (4800, "NA", 1)]


def test_promotion_leaves_old_versions_and_can_be_taken_back(spark, folder):
    assert promote.pointer(spark, folder) == (None, 0)
    promote.write_version(sold(spark, PRODUCTION), folder, "v1")
    promote.point_to(spark, folder, "v1")
    promote.write_version(sold(spark, REPLAY), folder, "replay")
    assert promote.current_gold(spark, folder).count() == 5
    report = {r.status: r.gold_rows for r in promote.replay_report(spark, folder, "replay").collect()}
    assert report == {"changed": 1, "same": 3, "only_replay": 1, "only_production": 1}
    promote.promote(spark, folder, "replay", "v2", *SPAN)
    assert promote.current_version(spark, folder) == "v2"
    assert promote.current_gold(spark, folder).count() == 5
    assert promote.current_gold(spark, folder).filter("region = 'APAC'").count() == 1
    promote.point_to(spark, folder, "v1")
    assert promote.current_gold(spark, folder).filter("region = 'APAC'").count() == 0


def test_promotion_writes_only_the_dates_it_touches(spark, folder):
    day = 86_400.0
    promote.write_version(sold(spark, [event(str(d), d * day) for d in range(5)]), folder, "v1")
    promote.point_to(spark, folder, "v1")
    promote.write_version(sold(spark, [event("again", 2 * day, amount=7.0)]), folder, "replay")
    promote.promote(spark, folder, "replay", "v2", at(2 * day), at(3 * day))
    runs = {r.window_date.day: r.run_id for r in promote.manifest(spark, folder, "v2").collect()}
    assert runs == {1: "v1", 2: "v1", 3: "v2", 4: "v2", 5: "v1"}
    rows = promote.current_gold(spark, folder).orderBy("window_start").collect()
    assert [r.revenue for r in rows] == [1.0, 1.0, 7.0, 1.0, 1.0]
    promote.write_version(sold(spark, []), folder, "empty")
    promote.promote(spark, folder, "empty", "v3", at(0), at(6 * day))
    assert promote.current_gold(spark, folder).count() == 0


def test_a_promotion_that_another_has_overtaken_is_refused(spark, folder):
    promote.write_version(sold(spark, PRODUCTION), folder, "v1")
    promote.point_to(spark, folder, "v1")
    _, seen = promote.pointer(spark, folder)
    promote.write_version(sold(spark, REPLAY), folder, "other")
    promote.point_to(spark, folder, "other")
    with pytest.raises(promote.StalePointer):
        promote.point_to(spark, folder, "v1", after=seen)
    assert promote.current_version(spark, folder) == "other"


def test_a_run_never_overwrites_a_version(spark, folder):
    promote.write_version(sold(spark, PRODUCTION), folder, "v1")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        promote.write_version(sold(spark, REPLAY), folder, "v1")


def test_replay_ranges_reach_the_scan(spark, folder):
    rows = [event(str(i), float(i), offset=i, kafka_partition=i % 3) for i in range(90)]
    silver_table(spark, rows).write.parquet(f"{folder}/bronze")
    stored = spark.read.parquet(f"{folder}/bronze")
    by_offset = backfill.replay_by_offset(stored, {0: (3, 9), 2: (80, 90)})
    assert sorted(r.kafka_offset for r in by_offset.collect()) == [3, 6, 80, 83, 86, 89]
    assert "PushedFilters: [Or(" in by_offset._jdf.queryExecution().executedPlan().toString().replace("\n", "")
    by_time = backfill.replay_by_time(stored, at(10), at(12))
    assert sorted(r.kafka_offset for r in by_time.collect()) == [10, 11]
    assert "GreaterThanOrEqual(kafka_ingest_ts" in by_time._jdf.queryExecution().executedPlan().toString()
    dated = silver_table(spark, [event(str(d), 86_400.0 * d, offset=d) for d in range(20)])
    dated.withColumn("ingest_date", F.to_date("kafka_ingest_ts")).write.partitionBy("ingest_date").parquet(f"{folder}/dated")
    few = backfill.replay_by_time(spark.read.parquet(f"{folder}/dated"), at(86_400 * 3), at(86_400 * 5))
    assert sorted(r.kafka_offset for r in few.collect()) == [3, 4]
    assert "PartitionFilters: [isnotnull(ingest_date" in few._jdf.queryExecution().executedPlan().toString()
    assert backfill.replay_by_offset(stored, {}).count() == 0


def test_partition_reports(spark):
    rows = [event(str(i), 0.0, offset=i, kafka_partition=min(i, 2) % 3, account_id=f"a{i % 2}") for i in range(10)]
    bronze = silver_table(spark, rows)
    spread = {r.kafka_partition: (r.records, r.first_offset, r.last_offset) for r in ops.partition_distribution(bronze).collect()}
    assert spread == {0: (1, 0, 0), 1: (1, 1, 1), 2: (8, 2, 9)}
    lag = {r.kafka_partition: r.lag for r in ops.offset_lag(bronze, bronze.filter("kafka_offset in (0, 5)")).collect()}
    assert lag == {0: 0, 1: 1, 2: 4}
    accounts = {r.account_id: r.partitions for r in ops.account_partitions(bronze).collect()}
    assert accounts == {"a0": 2, "a1": 2}


def test_quarantine_rate(spark):
    bronze = spark.range(10).select(
        F.when(F.col("id") < 2, "BAD_FRAME").when(F.col("id") == 2, "NO_EVENT_ID").alias("quarantine_reason")
    )
    got = {r.reason: (r.records, r.total_records, r.rate) for r in ops.quarantine_rate(bronze).collect()}
    assert got == {"BAD_FRAME": (2, 10, 0.2), "NO_EVENT_ID": (1, 10, 0.1)}


def test_latency_report(spark):
    rows = silver_table(spark, [event("a", ing=10.0), event("b", ing=400.0), event("c", 300.0, ing=300.0)])
    got = sorted((r.event_count, r.avg_latency_seconds, r.max_latency_seconds, r.latency_sla_breaches) for r in ops.latency_by_window(rows).collect())
    assert got == [(1, 0.0, 0, 0), (2, 205.0, 400, 1)]


def test_a_partial_replay_replaces_only_windows_it_has_seen_in_full(spark):
    """Events every 20 s, each up to ten minutes late; the replay covers arrivals of one hour."""
    rows = [
        event(str(i), 20.0 * i, ing=20.0 * i + (i * 37) % 601, offset=i, region=["NA", "EU"][i % 2])
        for i in range(600)
    ]
    full = sold(spark, rows)
    start, end = at(3600), at(7200)
    records = backfill.replay_by_time(silver_table(spark, rows), start, end)
    partial = gold.revenue_windows(silver.first_arrival(records))
    assert backfill.gold_diff(full, partial).filter("status = 'changed'").count() > 0
    complete = backfill.complete_windows(partial, start, end)
    assert complete.count() == 2 * 10
    statuses = {r.status for r in backfill.gold_diff(full, complete).select("status").distinct().collect()}
    assert statuses == {"same", "only_production"}
    merged = backfill.merge_windows(full, partial, start, end)
    assert {r.status for r in backfill.gold_diff(full, merged).select("status").distinct().collect()} == {"same"}


def test_backfill_of_records(spark, folder):
    values = [frame(body("a", 0.0)), frame(body("a", 0.0)), b"bad", frame(body("b", 400.0, amount=-2.0))]
    path = promote.backfill_gold(kafka_table(spark, values), registry(spark), folder, "r", {"from": "0", "to": "4"})
    promote.backfill_gold(kafka_table(spark, values[:1]), registry(spark), folder, "s")
    noted = {r.run_id: r.parameters for r in promote.runs(spark, folder).collect()}
    assert noted == {"r": {"from": "0", "to": "4"}, "s": None}
    stored = promote.read_version(spark, folder, "r").orderBy("window_start").collect()
    assert path.endswith("run_id=r")
    assert [(r.revenue, r.event_count) for r in stored] == [(1.0, 1), (-2.0, 1)]
