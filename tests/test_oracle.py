"""Every registered query against its SQL counterpart, on the smallest test tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()
QUERIES = contract.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


#: Queries whose operators SQL cannot express; these have tests of their own.
WITHOUT_SQL = {name for name in QUERIES if name == "pipeline" or name.startswith("op")}


def test_every_query_has_sql():
    assert set(SQL) >= set(QUERIES) - WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert oracle.differences(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
