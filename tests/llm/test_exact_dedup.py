import hashlib
import random
import re

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from salestide.llm import exact_dedup


def by_hand(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (key, _), text in zip(rows, texts):
        groups.setdefault(text, []).append(key)
    out = []
    for (key, _), text in zip(rows, texts):
        keys = [k for k in groups[text] if k is not None]
        out.append((key, min(keys) if keys else None, len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def sample():
    rnd = random.Random(3)
    words = ["alpha", "béta", "gamma", "delta", "x"]
    long = " ".join(rnd.choice(words) + str(rnd.randrange(999)) for _ in range(30000))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(4)))) for i in range(120)]
    rows += [(200, long), (201, long + "!"), (202, long.replace(" ", "\n\t")), (203, "a" * 100_000), (204, "a" * 100_000)]
    rows += [(300, None), (301, ""), (302, "  "), (303, "\x0b"), (304, " "), (None, "béta"), (None, "only\x1fhere")]
    return rows


def test_groups_equal_brute_force(spark):
    rows = sample()
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, recipe string").repartition(4)
    got = exact_dedup.duplicates(docs).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == by_hand(rows)
    for sha in {r.text_sha256 for r in got}:
        kept = [r for r in got if r.text_sha256 == sha and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_rows_that_repeat_whole_leave_one(spark):
    rows = [(1, "a b", "p"), (1, "a  b", "q"), (1, "a b", "p"), (2, "a\nb", "p"), (3, "c", "p"), (1, "d", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _sha_of_text string")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, re.sub(r"\s+", " ", r.text)) for r in kept.collect()) == [(1, "a b"), (1, "d"), (3, "c")]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicates(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0


def test_identifiers_that_clash_are_told_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one"), (4, "three"), (5, "")], "doc_id long, text string")
    clash = exact_dedup.recipes(docs).count()
    assert clash == 5

    class Weak:
        def __init__(self, chunk):
            self.chunk = chunk

        def digest(self):
            return b"o" if len(self.chunk) == 3 else b"t"

    import pyarrow as pa

    def weak_chunk(batches):
        old, exact_dedup.hashlib.sha256 = exact_dedup.hashlib.sha256, Weak
        try:
            yield from real(batches)
        finally:
            exact_dedup.hashlib.sha256 = old

    real = exact_dedup._chunk
    batch = pa.record_batch({"_row": [0, 1], "_key": [1, 2], "sha": ["a", "b"], "text": ["one", "two"]})
    assert [r.as_py() for r in next(weak_chunk([batch])).column("ids")] == [[b"o"], [b"o"]]
    monkeypatch.setattr(exact_dedup, "_chunk", weak_chunk)
    got = {r.doc_id: r.keep_id for r in exact_dedup.duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


@given(st.binary(max_size=3000), st.integers(0, 500))
def test_chunks_cover_the_text_and_settle_after_an_insert(data, at):
    data = data * 5
    ends = exact_dedup.cut_points(np.frombuffer(data, np.uint8))
    assert (ends[-1] if len(ends) else 0) == len(data)
    assert all(b > a for a, b in zip([0, *ends], ends))


def test_edited_texts_share_most_chunks():
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8)
    edited = np.insert(data, 1000, 7)

    def chunks(array):
        ends = exact_dedup.cut_points(array).tolist()
        return {array[a:b].tobytes() for a, b in zip([0, *ends], ends)}

    one, two = chunks(data), chunks(edited)
    assert len(one & two) > 0.9 * len(one)
