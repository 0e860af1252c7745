"""Every registered query against its SQL on DuckDB, and the expected row counts of FIXTURES.md."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from checks.queries import QUERIES, oracle_sql
from tests.conftest import SF

SQL = oracle_sql()

# rows at sf0.001
EXPECTED = {
    "d01_new_tables": 121,
    "d02_add_column": 522,
    "d03_alter_type": 663,
    "d04_set_not_null": 276,
    "d05_drop_not_null": 354,
    "d06_drop_default": 230,
    "d07_set_default": 332,
    "d08_columns_diff": 2377,
    "d11_sequences_diff": 33,
    "d12_views_diff": 21,
    "d13_dropped_tables": 105,
    "d14_dropped_columns": 199,
    "d15_dropped_constraints": 428,
    "d16_dropped_indexes": 435,
    "g04_dependency_closure": 150,
}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF, SQL[name]) is None


@pytest.mark.parametrize("name", EXPECTED)
def test_expected_rows(spark, name):
    assert QUERIES[name](spark, SF).count() == EXPECTED[name]


def test_flags(e):
    constraints, indexes = e.diffs["constraints_diff"], e.diffs["indexes_diff"]
    assert (constraints.where("is_new").count(), constraints.where("is_changed").count()) == (372, 60)
    assert (indexes.where("is_new").count(), indexes.where("is_changed").count()) == (461, 179)


def test_entry_has_every_query():
    assert QUERIES.keys() <= entry.queries().keys() and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["db_id", "operation_type", "n"]
    assert sum(r["n"] for r in out.collect()) == 2377
