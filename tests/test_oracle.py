"""Every registered query agrees with its SQL: column names, types and all rows."""

import pytest

import __spark_entry__ as contract
import compare
from catalog.oracle import ORACLE
from catalog.spark_queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 6


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = compare.open_tables(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, tables, name):
    df = contract.queries()[name](spark, sf_dir)
    columns, rows = compare.spark_rows(df)
    expected_columns, expected, kinds = compare.duck_rows(tables, ORACLE[name])
    assert columns == expected_columns
    assert compare.type_mismatches(df, kinds) == []
    assert rows == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
