"""Every registered query against its SQL oracle on whole tables."""

import pytest

import __spark_entry__ as contract
from claimsieve.bindings.oracles import all_oracles
from claimsieve.bindings.queries import all_queries
from tests.comparing import SF_DIR, oracle_bag, oracle_connection, spark_bag

SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection()


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_oracle(spark, oracle, name):
    df = all_queries()[name](spark, SF_DIR)
    columns, rows = spark_bag(df)
    oracle_columns, expected = oracle_bag(oracle, all_oracles()[name])
    assert columns == oracle_columns
    assert sum(expected.values()) > 0
    assert rows == expected
    types = {row[0]: row[1] for row in oracle.execute(f"DESCRIBE {all_oracles()[name]}").fetchall()}
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == types


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries()) and set(all_oracles()) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
