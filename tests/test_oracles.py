"""Every query with a SQL twin gives the same rows in DuckDB; every other query gives rows."""

import pytest
from compare import compare, connect

from kerbline.plans import QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    query = QUERIES[name]
    if query.sql is None:
        assert query(spark, folder).count() > 0
    else:
        assert compare(query, spark, folder, duck) is None
