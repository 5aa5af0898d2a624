"""The registered queries of this subpackage: names, oracles, and the same rows by another partitioning."""

import corpus_pipeline
import oracle
import pytest

import __spark_entry__ as entry
from salestide.llm import queries

SF = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert queries.QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert queries.ORACLES.items() <= entry.oracle_sql().items()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing",
    ]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    connection = oracle.connect(SF)
    result = queries.QUERIES[name](spark, SF)
    columns, expected = oracle.oracle_rows(connection, queries.ORACLES[name])
    assert sorted(result.columns) == columns
    rows = oracle.spark_rows(result)
    assert rows and rows == expected
