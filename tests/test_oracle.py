"""Every registered query agrees with its DuckDB SQL on the sf0.001 tables."""

import pytest

from conftest import SF001
from oracle_check import compare
from tastegraph.plans.catalog import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF001, [name], verbose=False)[name]
    assert res.get("ok", False), res
