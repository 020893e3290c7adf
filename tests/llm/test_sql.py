"""Training-data queries against their SQL."""

import pytest

from reelrank.llm.catalog import ORACLES, QUERIES
from test_oracle import SF_DIR, duck, table  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):  # noqa: F811
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    expected = table(want.columns, want.fetchall())
    assert expected[1] and table(got.columns, got.collect()) == expected
