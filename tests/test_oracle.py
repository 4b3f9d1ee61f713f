"""Every registered query against its SQL, on the smallest tables."""

import pytest

from gatelake.plans.queries import ORACLES, QUERIES
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert result["ok"] is not False, result
    assert not result.get("kinds"), result
    assert name in ORACLES
