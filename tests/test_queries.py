"""Every registered query with an oracle, against DuckDB on the smallest tables."""

import pytest

from tests.oracle import compare
from tracklab.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, duck, name):
    assert compare(spark, name, sf, duck) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
