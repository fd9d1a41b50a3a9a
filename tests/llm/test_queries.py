"""Every registered text query against its SQL, on the smallest tables."""

import pytest

from tests.oracle import normal_rows
from tracklab.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns, got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want_columns, want = normal_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert (columns, got) == (want_columns, want)


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
