"""Every query of the training-data operators against its SQL, on the smallest tables."""

import pytest

from gatelake.llm.queries import ORACLES, QUERIES
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
NO_SQL = {"op4_secrets", "op5_jaccard_join", "op6_licenses", "op7_sentencepiece", "op8_pii", "op10_quality_classifier", "op13_best_fit_packing"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert result["ok"] is True, result
    assert not result["kinds"], result


def test_all_have_a_check():
    assert set(QUERIES) == set(ORACLES) | NO_SQL
