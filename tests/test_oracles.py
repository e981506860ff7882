"""Every query with an oracle, against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from riskweave.plans import catalogue, oracles
from tests.compare import connect, differences

QUERIES = {name: contract.with_checkpoints(q) for name, q in catalogue.all_queries().items()}
ORACLES = oracles.all_oracles()

# A decision between fitted models has no SQL form; it is checked in test_pipelines.py.
ROWS_ONLY = {"champion_decision"}
# The full grid takes minutes; it is searched in the bench and by the driver.
SLOW = {"tuning_results"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as con:
        yield con


def test_only_models_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_returns_rows(spark):
    (row,) = contract.entry(spark).collect()
    assert (row["cards"], row["precision"]) == (5, row["frauds"] / 5)
