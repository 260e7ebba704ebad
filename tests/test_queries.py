"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest
from compare import connect, differences

from lakespark.queries import load

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) is None
    else:
        assert df.count() >= 0
