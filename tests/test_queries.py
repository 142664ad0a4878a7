"""Every query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert differences(df, con, oracle_sql()[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).columns[0] == "pain_id"
