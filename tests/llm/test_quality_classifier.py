import random
import zlib

import numpy as np
import pytest

from salestide.llm import quality

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in truth if got[i].held_out]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95


def test_held_out_labels_and_other_columns_do_not_matter(spark, tables):
    docs, labels = tables
    some = docs.filter("doc_id < 400")
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end quality"
    )
    changed = some.selectExpr("doc_id", "text", "'xx' lang", "'s' source", "1 score")
    one = {r.doc_id: r.score for r in quality.classify(some, labels).collect()}
    two = {r.doc_id: r.score for r in quality.classify(changed, flipped).collect()}
    assert one.keys() == two.keys() and all(abs(one[i] - two[i]) < 1e-6 for i in one)


def test_normal_equations_are_the_sums_over_all_rows(spark):
    rng = np.random.default_rng(5)
    d = len(quality.STATISTICS)
    model = quality.QualityModel(
        np.zeros(d), np.ones(d), rng.normal(size=(d, 12)), rng.uniform(0, 6, 12), np.zeros(13), np.array([0.0]), np.array([0.0])
    )
    rows = [(rng.normal(size=d).tolist(), float(i % 3 == 0)) for i in range(333)]
    frame = spark.createDataFrame(rows, "stats array<double>, label double").repartition(7)
    left, right = quality._normal_equations(frame, model)
    features = model.fourier(np.array([r[0] for r in rows]))
    assert np.allclose(left, features.T @ features) and np.allclose(right, features.T @ np.array([r[1] for r in rows]))


def test_kernel_is_approximated():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    model = quality.QualityModel(
        np.zeros(d), np.ones(d), rng.normal(size=(d, 4096)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, 4096), np.zeros(4097),
        np.array([0.0]), np.array([0.0]),
    )
    a, b = rng.normal(size=(20, d)), rng.normal(size=(20, d))
    near = model.fourier(a)[:, 1:] @ model.fourier(b)[:, 1:].T
    exact = np.exp(-((a[:, None] - b[None]) ** 2).sum(2) / (2 * d))
    assert np.abs(near - exact).max() < 0.1


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "word " * 200_000), (None, "a b c"), (5, "x"), (5, "x"), (6, "\x00\x01"), (7, "\n\n")]
    docs = spark.createDataFrame([(*r, 3.0) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (4, 0), (6, 1), (5, 1), (5, 0), (None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_rejected_documents_go_and_columns_stay(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    good = [" ".join(rnd.choices(words, k=60)) for _ in range(150)]
    bad = [" ".join([rnd.choice(words)] * 60) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "l") for i, t in enumerate(good + bad)], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids ^ set(range(150))) <= 3
