"""Every text query that SQL can express, value by value."""

import pytest

from riskweave.llm import queries
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_matches_sql(spark, sf_dir, name):
    result = queries.all_queries()[name](spark, sf_dir)
    assert differences(result, connect(sf_dir), queries.all_oracles()[name]) == []
