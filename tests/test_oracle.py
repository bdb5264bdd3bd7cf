"""Every registered query agrees exactly with its DuckDB oracle at sf0.01."""

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_ORACLE), reason="test data not present")

SQL = E._report_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(E._report_queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got, want = compare(E.queries()[name](spark, SF_ORACLE), SQL[name], con)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["fin_id", "area_code", "value", "month_key"]
    assert df.count() > 0
