import pytest
from pyspark.sql import functions as F
from test_ngram_join import compare, sample, shingles

from salestide import session
from salestide.llm import ngram_join, sieve, text
from salestide.session import materialize, small_broadcasts


def test_all_rows_with_a_key_pass_and_few_others(spark):
    key = F.when(F.col("id") % 1000 != 0, F.col("id"))
    rows = spark.range(100_000).select(key.alias("k"), F.lit("x").alias("_block"), F.col("id").cast("string").alias("_HELD"), F.lit(1).alias("a.b"))
    keys = materialize(rows.filter("k % 7 = 0 or k is null").select(F.col("k").alias("_k"), F.col("_held").alias("_m")), "keys")
    maybe, others = sieve.split(rows, keys, [rows["k"], rows["_HELD"]], [keys["_k"], keys["_m"]])
    assert maybe.columns == others.columns == rows.columns
    passed, rest = ({r._HELD for r in part.collect()} for part in (maybe, others))
    wanted = {r._m for r in keys.collect()}
    assert wanted <= passed and not passed & rest and len(passed | rest) == 100_000
    assert len(passed - wanted) < 2 * (100_000 - len(wanted)) / sieve.BITS_A_KEY
    none = materialize(keys.limit(0), "none")
    maybe, others = sieve.split(rows, none, [rows["k"], rows["_HELD"]], [none["_k"], none["_m"]])
    assert (maybe.count(), others.count()) == (0, 100_000)


def test_dropped_keys_are_not_broadcast_beyond_a_bound(spark):
    """The driver would hold some hundred bytes for each; rows that repeat key and mark of a kept row stay once."""
    docs = spark.range(200_000).select(F.when(F.col("id") != 5, F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("_k"), F.lit(7).alias("kept"))
    docs = docs.union(docs.filter("doc_id in (3, 4)"))
    mark = F.xxhash64("doc_id")
    decided = docs.select("doc_id", mark.alias("m"), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)).alias("kept"))
    decided = decided.union(decided.filter("doc_id = 6").withColumn("kept", F.lit(True)))
    kept = text.keep_one(docs, lambda: decided, "doc_id", "m", mark)
    assert kept.columns == docs.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # Of what is told apart by key, rows of a bitmap are broadcast, not the keys.
    assert "LeftAnti" in plan and not any("BroadcastHashJoin" in line and "LeftAnti" in line for line in plan.splitlines())
    want = sorted([i for i in range(200_000) if i % 3 and i != 5] + [4, 6])
    assert sorted(r.doc_id for r in kept.collect()) == want


@pytest.mark.parametrize("size, share", [(3, 90), (5, 80)])
def test_near_copies_looked_up_by_bits_equal_brute_force(spark, monkeypatch, size, share):
    used, real = [], sieve.split
    monkeypatch.setattr(sieve, "split", lambda *a: used.append(a) or real(*a))
    monkeypatch.setattr(text, "split", sieve.split)
    monkeypatch.setattr(ngram_join, "MAX_BROADCAST_WANTED", 0)
    monkeypatch.setattr(text, "MAX_BROADCAST_GONE", 0)
    rows = sample()
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, prefix string, n long").repartition(3)
    got = ngram_join.join(docs, size=size, share=share).collect()
    compare(got, rows, size, share)
    kept = ngram_join.keep_one_of_each(docs, size=size, share=share)
    assert kept.columns == docs.columns
    # A row for each component; those of empty sets stay.
    assert kept.count() == sum(r.kept for r in got) and len(used) > 6
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and shingles(r.text)) == sorted(
        r.doc_id for r in got if r.kept and r.doc_id is not None and r.n_shingles
    )


def test_large_tables_of_ids_are_not_broadcast_meanwhile(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    own = spark.newSession()
    before = own.conf.get(name)
    with small_broadcasts(own):
        assert own.conf.get(name) == str(session.SMALL_BROADCAST)
    assert own.conf.get(name) == before
    own.conf.set(name, "300k")
    with small_broadcasts(own):
        assert own.conf.get(name) == "300k"
    assert own.conf.get(name) == "300k"
