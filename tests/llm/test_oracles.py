"""Queries with SQL agree with DuckDB; queries with none are held against plain Python elsewhere."""

import os

import pytest

from areabook.llm import queries as Q
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_ORACLE), reason="test data not present")


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_oracle(spark, name):
    got, want = compare(Q.QUERIES[name](spark, SF_ORACLE), Q.ORACLES[name], duck(SF_ORACLE))
    assert len(got) == len(want) and got == want
