import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rows import event, silver_table
from salestide.functions.rules import Rules, net_amount
from salestide.operators import gold, quality
from salestide.sources.files import dq_history, read_dq_metrics, read_dq_samples
from salestide.streaming.dq_sink import write_dq_batch

NAN = float("nan")


@pytest.fixture
def seven(spark):
    return silver_table(spark, [
        event("a"), event("b", plan_tier=None), event("c", plan_tier=None, region="XX"),
        event("d", amount=None, ing=False), event("e", amount=NAN, ing=301.0), event("f", amount=0.0, ing=300.0),
        event("g", amount=-0.0, ing=-5.0),
    ])


def test_flags(seven):
    flags = quality.dq_flags(seven).orderBy("event_id")
    got = {
        r.event_id: (r.f_null_required, r.f_invalid_domain, r.f_bad_amount, r.f_latency_breach, r.f_invalid_any)
        for r in flags.collect()
    }
    assert got == {
        "a": (False, False, False, False, False), "b": (True, None, False, False, True),
        "c": (True, True, False, False, True), "d": (True, False, True, None, True),
        "e": (False, False, True, True, True), "f": (False, False, True, False, True),
        "g": (False, False, True, False, True),
    }


def test_metrics(seven):
    assert quality.dq_metrics(seven).first().asDict() == {
        "total_records": 7, "valid_records_estimate": 1, "null_required_fields": 3, "invalid_domain_values": 1,
        "bad_amounts": 4, "latency_sla_breaches": 1,
    }


def test_metrics_are_zero_when_a_rule_is_null_for_all_rows(spark):
    rows = silver_table(spark, [event("a", plan_tier=None, ing=False)])
    metrics = quality.dq_metrics(rows).first()
    assert (metrics.invalid_domain_values, metrics.latency_sla_breaches, metrics.total_records) == (0, 0, 1)


def test_metrics_of_nothing(spark):
    assert list(quality.dq_metrics(silver_table(spark, [])).first()) == [0] * 6


def test_negative_amounts_are_refunds_and_infinity_passes(spark):
    rows = silver_table(spark, [event("a", amount=-5.0), event("b", amount=math.inf)])
    assert quality.dq_metrics(rows).first().bad_amounts == 0


def test_latency_drops_fractions_first(spark):
    rows = silver_table(spark, [event("a", ev=0.9, ing=301.1), event("b", ev=0.0, ing=300.9), event("c", ev=0.999, ing=301.0)])
    flagged = quality.dq_flags(rows).filter("f_latency_breach").select("event_id").collect()
    assert sorted(r[0] for r in flagged) == ["a", "c"]


def test_sla_is_a_parameter(spark):
    rows = silver_table(spark, [event("a", ing=30.0)])
    assert quality.dq_metrics(rows, Rules(latency_sla_seconds=29)).first().latency_sla_breaches == 1


def test_violation_reasons(seven):
    got = {r.event_id: r.dq_violation_reason for r in quality.dq_violations(seven).collect()}
    assert got == {
        "b": "NULL_REQUIRED", "c": "NULL_REQUIRED|INVALID_DOMAIN", "d": "NULL_REQUIRED|BAD_AMOUNT",
        "e": "BAD_AMOUNT|LATENCY_SLA_BREACH", "f": "BAD_AMOUNT", "g": "BAD_AMOUNT",
    }


def test_a_row_can_violate_latency_only(spark):
    rows = silver_table(spark, [event("a", ing=999.0)])
    assert quality.dq_violations(rows).first().dq_violation_reason == "LATENCY_SLA_BREACH"
    assert quality.dq_metrics(rows).first().valid_records_estimate == 1


@pytest.mark.parametrize("salts", [1, 7, 64])
def test_samples_equal_brute_force_when_one_batch_holds_most_rows(spark, salts):
    pairs = [(0 if i % 10 else i % 4, f"{(i * 7919) % 5000:05d}") for i in range(5000)]
    df = spark.createDataFrame(pairs, "batch_id int, event_id string").repartition(8)
    expected = defaultdict(list)
    for batch, key in sorted(pairs):
        expected[batch].append(key)
    got = defaultdict(list)
    for row in quality.dq_samples(df, cap=20, salts=salts).collect():
        got[row.batch_id].append(row.event_id)
    assert {b: sorted(v) for b, v in got.items()} == {b: v[:20] for b, v in expected.items()}


def test_gate_splits_all_rows(seven):
    valid, invalid = gold.split_by_rules(seven)
    assert [r.event_id for r in valid.collect()] == ["a"]
    assert sorted(r.event_id for r in invalid.collect()) == list("bcdefg")


def test_batch_output_and_retry(spark, seven, folder):
    for _ in range(2):
        write_dq_batch(seven, 4, folder, "r1")
    write_dq_batch(seven.filter("event_id = 'a'"), 6, folder, "r1", persist=False)
    write_dq_batch(seven.filter("false"), 8, folder, "r1")
    write_dq_batch(seven, 4, folder, "r2")
    metrics = read_dq_metrics(spark, folder, "r1").orderBy("batch_id").collect()
    assert [(m.batch_id, m.total_records, m.bad_amounts) for m in metrics] == [(4, 7, 4), (6, 1, 0)]
    assert all(m.dq_run_ts is not None for m in metrics)
    samples = read_dq_samples(spark, folder, "r1").orderBy("event_id").collect()
    assert [s.event_id for s in samples] == list("bcdefg")
    assert math.isnan(samples[3].amount) and samples[2].amount is None
    history = {r.batch_id: r.sample_rows for r in dq_history(spark, folder, "r1").collect()}
    assert history == {4: 6, 6: 0}


def test_sample_cap_of_a_batch(spark, folder):
    rows = silver_table(spark, [event(f"{i:03d}", amount=0.0) for i in reversed(range(130))])
    write_dq_batch(rows.repartition(8), 0, folder, "r")
    kept = sorted(r.event_id for r in read_dq_samples(spark, folder, "r").collect())
    assert kept == [f"{i:03d}" for i in range(100)]


def test_net_amount(spark):
    kinds = ["subscription_created", "renewal", "upgrade", "refund", "chargeback"]
    df = spark.createDataFrame([(k, 49.0) for k in kinds], "event_type string, gross double")
    got = {r.event_type: r.net for r in df.withColumn("net", net_amount(F.col("event_type"), F.col("gross"))).collect()}
    assert got == {k: (-49.0 if k in ("refund", "chargeback") else 49.0) for k in kinds}
