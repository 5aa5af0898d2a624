"""Versions compared by digests, first promotions, latency sketches, order within accounts, offsets by day."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rows import at, event, silver_table
from salestide import contract as c
from salestide.functions.rules import latency_seconds
from salestide.operators import backfill, latency, ops
from salestide.streaming import promote

DAY = 86400.0


def gold(spark, rows):
    """Rows of (seconds, region, plan, revenue, events)."""
    return spark.createDataFrame([(at(s), at(s + 300), *rest) for s, *rest in rows], c.GOLD_SCHEMA)


ROWS = [(d * DAY + h * 3600.0 + w * 300.0, region, "pro", float(d + h + w), 3) for d in range(4) for h in range(0, 24, 6) for w in range(2) for region in ("EU", None)]


def test_diff_of_versions_equals_the_whole_comparison(spark, folder):
    changed = [r for r in ROWS if r[0] != DAY]  # a window is gone
    changed = [(*r[:3], r[3] + (1.0 if r[0] == 2 * DAY + 300.0 else 0.0), r[4]) for r in changed]  # a window's revenue moved
    changed += [(2 * DAY + 7 * 3600.0, "NA", None, None, 1)]  # a new one, without revenue
    changed = [(*r[:3], None if r[3] is None else r[3] + 1e-10, r[4]) for r in changed]  # another order of sums
    promote.write_version(gold(spark, ROWS), folder, "one")
    promote.write_version(gold(spark, changed), folder, "two")
    whole = backfill.gold_diff(gold(spark, ROWS), gold(spark, changed)).filter("status <> 'same'")
    found = promote.diff_versions(spark, folder, "one", "two")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))
    assert {r.status for r in found.collect()} == {"only_production", "only_replay", "changed"}
    opened = {f.split("window_date=")[1][:10] for f in found.inputFiles() if "/versions/" in f}
    assert opened == {"2026-01-02", "2026-01-03"}
    assert promote.diff_versions(spark, folder, "one", "one").count() == 0


def test_dates_taken_over_are_equal_at_once(spark, folder):
    promote.write_version(gold(spark, ROWS), folder, "one")
    promote.point_to(spark, folder, "one")
    promote.write_version(gold(spark, [(*r[:4], 5) for r in ROWS]), folder, "replay")
    promote.promote(spark, folder, "replay", "two", at(DAY), at(2 * DAY))
    found = promote.diff_versions(spark, folder, "one", "two")
    opened = {f.split("window_date=")[1][:10] for f in found.inputFiles() if "/versions/" in f}
    assert opened == {"2026-01-02"}
    assert found.count() == 16 and {(r.events_production, r.events_replay) for r in found.collect()} == {(3, 5)}


def test_a_first_promotion_has_an_empty_production(spark, folder):
    promote.write_version(gold(spark, ROWS), folder, "replay")
    promote.promote(spark, folder, "replay", "one", at(DAY), at(3 * DAY))
    assert promote.current_gold(spark, folder).count() == 32
    assert {r.window_start.day for r in promote.current_gold(spark, folder).collect()} == {2, 3}


def test_percentiles_are_within_their_error_for_any_range(spark):
    rng = random.Random(4)
    seconds = [rng.choice([0, 1, 5, 63, 64, 65]) if i % 3 else int(math.exp(rng.uniform(0, 14))) for i in range(900)] + [-5, -700]
    rows = [event(str(i), 7200.0 * (i % 5), ing=7200.0 * (i % 5) + s) for i, s in enumerate(seconds)] + [event("null", 0.0, ing=False)]
    sketches = latency.latency_sketches(silver_table(spark, rows))
    assert sketches.count() == 5 and sum(r.events for r in sketches.collect()) == len(seconds)

    def exact(values, share):
        return sorted(values)[math.ceil(len(values) * share) - 1]

    def close(got, want):
        return abs(got - want) <= abs(want) * 2.0 ** -latency.BITS

    whole = latency.percentiles(sketches).first()
    assert all(close(whole[name], exact(seconds, share)) for name, share in latency.PERCENTILES.items())
    for r in latency.percentiles(sketches, ["window_start"]).collect():
        hour = r.window_start.hour // 2
        part = [s for i, s in enumerate(seconds) if i % 5 == hour]
        assert r.events == len(part)
        assert all(close(r[name], exact(part, share)) for name, share in latency.PERCENTILES.items())
    assert latency.percentiles(sketches.limit(0), ["window_start"]).count() == 0


def test_a_bucket_holds_its_middle(spark):
    values = spark.range(0, 70_000).select(F.col("id").alias("s")).union(spark.range(1, 40).select(F.expr("int(pow(3, id % 19)) * -1")))
    bad = values.withColumn("m", latency.middle(latency.bucket(F.col("s")))).filter("abs(m - s) > abs(s) / 64.0")
    assert bad.count() == 0
    assert values.filter(latency.bucket(F.col("s")) != latency.bucket(latency.middle(latency.bucket(F.col("s"))))).count() == 0
    assert silver_table(spark, [event("a", 0.0, ing=12.0)]).select(latency.bucket(latency_seconds())).first()[0] == 12


@pytest.mark.parametrize("partitions", [1, 6])
def test_order_of_a_hot_account_over_many_ranges(spark, partitions):
    rng = random.Random(partitions)
    rows = [event(str(i), float(rng.randint(0, 500)), offset=i, account_id="hot" if i % 3 else f"a{i % 7}", kafka_partition=i % 2) for i in range(900)]
    rows += [event("n", 1.0, offset=1000, account_id=None), event("m", 0.0, offset=1001, account_id=None)]
    expected: dict = {}
    newest: dict = {}
    for r in sorted(rows, key=lambda r: r["kafka_offset"]):
        place = r["account_id"], r["kafka_partition"]
        n, inversions, worst = expected.get(r["account_id"], (0, 0, 0))
        behind = int((newest.get(place, r["event_ts"]) - r["event_ts"]).total_seconds() * 1e6)
        newest[place] = max(newest.get(place, r["event_ts"]), r["event_ts"])
        expected[r["account_id"]] = n + 1, inversions + (behind > 0), max(worst, behind)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.account_id: (r.records, r.inversions, r.worst_micros) for r in ops.account_order(silver_table(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected
    assert ops.account_order(silver_table(spark, rows[:1]).limit(0)).count() == 0


def test_offsets_by_day_open_only_days_that_hold_them(spark, folder):
    rows = [event(str(i), i * 3600.0, offset=i) for i in range(240)]
    table = silver_table(spark, rows).withColumn("ingest_date", F.to_date("kafka_ingest_ts"))
    table.write.partitionBy("ingest_date").parquet(f"{folder}/bronze")
    bronze = spark.read.schema(c.extend(c.SILVER_SCHEMA, ingest_date=c.DATE)).parquet(f"{folder}/bronze")
    days = backfill.offset_ranges(bronze)
    assert days.count() == 10
    got = backfill.replay_by_offset(bronze, {0: (30, 50), 1: (0, 1000)}, days)
    assert sorted(r.kafka_offset for r in got.collect()) == list(range(30, 50))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ingest_date" in plan and "20455" in plan or "2026-01-02" in plan
    assert backfill.replay_by_offset(bronze, {5: (0, 10)}, days).count() == 0
