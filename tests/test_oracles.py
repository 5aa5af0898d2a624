"""Every registered query against its oracle SQL on the given tables."""

import pytest

import __spark_entry__ as entry
import oracle
from salestide.plans import catalog, oracles

SF = "/root/testdata/sf0.01"
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.all_queries()) == set(oracles.all_oracles())
    assert catalog.all_queries().keys() <= entry.queries().keys()
    assert oracles.all_oracles().items() <= entry.oracle_sql().items()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query_equals_oracle(spark, duck, name):
    sql = oracles.all_oracles()[name]
    result = catalog.all_queries()[name](spark, SF)
    columns, expected = oracle.oracle_rows(duck, sql)
    assert sorted(result.columns) == columns
    types = {field.name: field.dataType.simpleString() for field in result.schema.fields}
    assert types == {column: SPARK_TYPES[kind] for column, kind in oracle.types(duck, sql).items()}
    rows = oracle.spark_rows(result)
    assert len(rows) > 0
    assert rows == expected
