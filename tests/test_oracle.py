"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from corridor.plans import catalog
from corridor.plans.verify import compare, duck_connect
from tests.conftest import SF_SMALL

catalog.load_all()
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "speed_rank" in df.columns
