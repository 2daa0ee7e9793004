"""The llm queries against their SQL, and without it on the smallest tables."""

import os

import pytest
from oracle import SF_DIR, both

from curlew.llm.queries import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    found, expected = both(spark, QUERIES[name], ORACLES[name])
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
