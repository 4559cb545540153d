"""Every query with SQL gives the same rows as DuckDB on the small tables."""

import pytest

from basketry.plans.catalog import CATALOG
from tools.check_oracles import connect, differences

from .conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.oracle])
def test_query_matches_sql(spark, duck, name):
    query = CATALOG[name]
    assert differences(query.run(spark, SMALL), duck, query.oracle) == ""
