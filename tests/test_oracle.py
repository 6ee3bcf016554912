"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_compare import connect, difference, spark_rows, sql_rows

from __spark_entry__ import entry, oracle_sql, queries
from pixelproof.workloads.oracle import SQL
from pixelproof.workloads.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_answer(spark, con, name):
    names, ours = spark_rows(REGISTRY[name](spark, SF_DIR))
    expected_names, expected = sql_rows(con, SQL[name])
    assert names == expected_names
    assert ours == expected, difference(ours, expected)


def test_entry_compares_both_models(spark):
    assert {r["model"] for r in entry(spark).collect()} == {"LogisticRegression", "RandomForest"}
