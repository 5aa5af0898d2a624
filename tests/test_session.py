"""Working tables and when they end."""

import os

import pytest

from salestide import session


def path_of(df):
    return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_tables_of_a_block_end_with_it(spark):
    outside = session.materialize(spark.range(3), "outside")
    with session.scratch(spark) as keep:
        gone = path_of(session.materialize(spark.range(3), "gone"))
        with session.scratch(spark) as inner:
            kept = inner(session.materialize(spark.range(4), "kept"))
            passed = path_of(inner(session.materialize(spark.range(4), "passed")))
            gone_too = path_of(session.materialize(spark.range(3), "gone"))
        assert not os.path.exists(gone_too) and os.path.exists(passed)
        keep(kept)
    assert not os.path.exists(gone) and not os.path.exists(passed)
    assert kept.count() == 4 and outside.count() == 3


def test_a_block_that_fails_leaves_nothing(spark):
    with pytest.raises(KeyError):
        with session.scratch(spark) as keep:
            path = path_of(keep(session.materialize(spark.range(3), "x")))
            raise KeyError
    assert not os.path.exists(path)


def test_a_table_is_discarded_once(spark):
    table = session.materialize(spark.range(3), "x")
    path = path_of(table)
    session.discard(table)
    session.discard(table)
    assert not os.path.exists(path)
    session.discard(spark.range(3))  # no working table
    session.release(spark)


def test_folders_are_listed_moved_and_removed(spark, folder):
    for n in (2, 1):
        spark.range(1).write.parquet(f"{folder}/a/n={n}")
    assert [p.rsplit("/", 1)[1] for p in session.folders(spark, f"{folder}/a/n=*")] == ["n=1", "n=2"]
    session.rename(spark, f"{folder}/a/n=1", f"{folder}/b/c/n=1")
    assert session.exists(spark, f"{folder}/b/c/n=1/_SUCCESS") and not session.exists(spark, f"{folder}/a/n=1")
    with pytest.raises(OSError):
        session.rename(spark, f"{folder}/none", f"{folder}/b/x")
    session.remove(spark, f"{folder}/a")
    session.remove(spark, f"{folder}/a")
    assert session.folders(spark, f"{folder}/a/*") == []
