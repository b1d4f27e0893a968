"""Serving queries take every order as a request: their SQL without a filter on orders."""

import pytest
from test_oracles import ORACLES, QUERIES, SF, duck, ordered  # noqa: F401


@pytest.mark.parametrize("name", ["get_slice", "uniform_frames", "rewind_sample", "window_pool"])
def test_every_order_is_served(spark, duck, name):  # noqa: F811
    rel = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, SF).select(*rel.columns).collect()
    assert ordered(got) == ordered(rel.fetchall())
