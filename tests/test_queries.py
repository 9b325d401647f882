"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from tests import oracle

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    columns, rows = oracle.actual(QUERIES[name](spark, str(oracle.DATA)))
    wanted_columns, wanted = oracle.expected(ORACLES[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert rows, "a query must have rows to compare"
    assert rows == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, str(oracle.DATA)).head(1)
