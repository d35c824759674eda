"""Differential test: every query key against its DuckDB oracle.

Runs at sf0.001 by default (STAFFLINE_TEST_SF overrides); the driver's
check runs the same comparison at sf0.01 (see tests/oracle_compare.py).
"""

import os

import pytest

import __spark_entry__ as E
from staffline.plans import QUERIES
from tests.oracle_compare import compare, duck

SF = os.environ.get("STAFFLINE_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(QUERIES)  # the optional text and vector keys have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF, con)
    assert r["status"] == "OK", r


def test_every_key_documented():
    for k, fn in E.queries().items():
        assert fn.__doc__, k


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "id"
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
