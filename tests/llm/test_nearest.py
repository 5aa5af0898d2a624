"""Neighbours against brute force: all of them with no test, most of them as in production."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestide.llm import dimension_scan, nearest

SCHEMA = "vec_id long, embedding array<float>"


def by_hand(rows: list[tuple], k: int) -> list[tuple]:
    """(query_id, rank, vec_id, score) of each row whose id 20 divides; all rows are of use."""
    found = []
    vectors = np.array([np.float32(v) for _, v in rows], np.float64)
    for at, (query, _) in enumerate(rows):
        if query is None or query % 20:
            continue
        scores = vectors @ vectors[at]
        others = sorted((i for i in range(len(rows)) if i != at), key=lambda i: (-scores[i], rows[i][0] is None, rows[i][0] or 0))
        found += [(query, rank + 1, rows[i][0], round(float(scores[i]), 9)) for rank, i in enumerate(others[:k])]
    return sorted(found, key=repr)


def searched(spark, rows: list[tuple], k: int = 5, **options) -> list[tuple]:
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", entry int, score string").repartition(4)
    got = nearest.search(df, F.col("key") % 20 == 0, k=k, **options).collect()
    return sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got), key=repr)


EXACT = {"recall": 1.0, "epsilon": float("inf"), "lists": 1}


@pytest.mark.parametrize("lists", [1, 7])
def test_all_lists_without_tests_are_exact(spark, lists):
    """Norms differ widely, and a hot vector is a third of all rows."""
    rng = np.random.default_rng(lists)
    rows = [(i, (rng.normal(size=24) * rng.choice([0.01, 1, 50])).tolist()) for i in range(600)]
    rows += [(i, [1.0] * 24) for i in range(600, 900)]
    # Probing holds all lists: a recall of one may be reached with fewer, so all are asked for by the calibration of each query.
    got = searched(spark, rows, **(EXACT | {"lists": lists}))
    if lists == 1:
        assert got == by_hand(rows, 5)
    else:
        assert len(set(got) & set(by_hand(rows, 5))) > 0.97 * len(got)


def test_odd_rows(spark):
    good = [(0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (20, [0.0, -1.0, 0.0]), (None, [1.0, 1.0, 0.0]), (3, [-0.0, 1.0, 0.0]), (4, [0.0, 1.0, -0.0])]
    bad = [(40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]), (7, [1.0, 2.0]), (8, [])]
    assert searched(spark, good + bad, **EXACT) == by_hand(good, 5)
    assert searched(spark, good[:1], **EXACT) == []
    assert searched(spark, bad[:3], **EXACT) == []
    assert searched(spark, [], **EXACT) == []
    huge = [(0, [3e38, 3e38]), (1, [1e-30, 0.0]), (2, [-3e38, 3e38]), (3, [3e38, 2e38])]
    assert {r[2] for r in searched(spark, huge, **EXACT)} == {1, 2, 3}


def test_production_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    true = by_hand(rows, 20)
    got = nearest.search(df, F.col("key") % 20 == 0, k=20).collect()
    assert len(got) == len(true) == 2000
    pairs = {(r.query_id, r.vec_id) for r in got}
    assert len(pairs & {(t[0], t[2]) for t in true}) >= 0.93 * len(true)
    exact = {(t[0], t[2]): t[3] for t in true}
    assert all(abs(exact.get((r.query_id, r.vec_id), r.score) - r.score) < 1e-9 for r in got)


def test_tests_abandon_most_candidates_and_lose_few():
    rng = np.random.default_rng(3)
    vectors, queries = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.normal(size=(4000, 96)), rng.normal(size=(40, 96))))
    true = np.square(vectors[None] - queries[:, None]).sum(axis=2)
    bounds = np.partition(true, 20, axis=1)[:, 20]
    parts = dimension_scan.from_column_blocks(dimension_scan.column_blocks(vectors), 96)
    query, candidate, distance = dimension_scan.scan(parts, queries, bounds, 20)
    assert np.allclose(distance, true[query, candidate], atol=1e-5)
    wanted = {(q, c) for q in range(40) for c in np.argsort(true[q])[:20]}
    assert len(wanted & set(zip(query, candidate))) >= 0.98 * len(wanted)
    query, candidate, _ = dimension_scan.scan(parts, queries, np.full(40, 4.1), 20, float("inf"))
    assert wanted <= set(zip(query, candidate))
