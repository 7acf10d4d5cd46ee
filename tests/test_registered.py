"""Every registered query against its SQL statement, in a session that is not in UTC."""

import __spark_entry__ as entry_points
import pytest
from compare import compare, duck

from openloop.bindings.oracles import ORACLES
from openloop.bindings.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert compare(result, entry_points.oracle_sql()[name], con) == []


def test_entry_runs_the_flagship(spark):
    assert entry_points.entry(spark).count() == 68


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
