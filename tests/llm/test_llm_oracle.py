"""Every text query with SQL against DuckDB on the smallest tables; the rest return whole tables."""

import pytest

from corridor.llm import queries as Q
from corridor.plans.verify import compare, duck_connect
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, Q.QUERIES[name], Q.ORACLE[name], SF_SMALL)
    assert ok, msg


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
