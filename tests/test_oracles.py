"""Every query with a SQL twin gives the same values on the smallest driver tables."""

import oracle
import pytest
from conftest import SF

from opsloom.catalog import ORACLES, QUERIES

# Queries that find nothing in the smallest tables.
EMPTY: frozenset[str] = frozenset()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


def test_all_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    problem = oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert problem == ("equal but empty" if name in EMPTY else None)
