"""Searches that go on after an end, and that halve their field."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from riskweave.plans import pipelines, training
from riskweave.plans.trials import TrialStore, data_digest, trial_key


@pytest.fixture
def trees():
    return pipelines.gradient_boosted_trees(maxIter=2)


@pytest.fixture
def fits(monkeypatch):
    """Points fitted, in any order; the fit after ``fits.limit`` of them fails."""

    class Fits(list):
        limit = 1000

    seen, plain = Fits(), GBTClassifier.fit

    def fit(self, data, params=None):
        if len(seen) >= seen.limit:
            raise RuntimeError("ended")
        seen.append({p.name: v for p, v in (params or {}).items()})
        return plain(self, data, params)

    monkeypatch.setattr(GBTClassifier, "fit", fit)
    return seen


def test_an_ended_search_goes_on(spark, transactions, trees, fits, tmp_path):
    grid = training.parameter_grid(trees, depths=(1, 2), min_instances=(5, 300))
    path = str(tmp_path / "trials")
    fits.limit = 2
    with pytest.raises(RuntimeError, match="ended"):
        training.tune(transactions, trees, grid, parallelism=1, trials_path=path)
    assert len(TrialStore(spark, path).known()) == 2

    fits.limit = 1000
    shuffled = transactions.repartition(7)
    resumed = training.tune(shuffled, trees, grid, parallelism=1, trials_path=path)
    assert len(fits) == 2 + 2 + 1  # two more trials and the last fit

    fits.clear()
    again = training.tune(transactions, trees, grid, trials_path=path)
    assert len(fits) == 1 and again.trials == resumed.trials and again.best == resumed.best
    rows = TrialStore(spark, path).table().collect()
    assert len(rows) == 4 and {r["share"] for r in rows} == {1.0}

    fits.clear()
    plain = training.tune(transactions, trees, grid[:1])
    assert len(fits) == 2 and plain.best.auc == pytest.approx(resumed.trials[0].auc, abs=1e-9)


def test_halving(transactions, trees, fits, tmp_path):
    grid = training.parameter_grid(trees, depths=(1, 3), min_instances=(5, 400))
    path = str(tmp_path / "trials")
    result = training.tune(transactions, trees, grid, trials_path=path, shares=(0.5, 1.0))
    assert [t.share for t in result.trials] == [0.5] * 4 + [1.0] * 2
    first, last = result.trials[:4], result.trials[4:]
    best = sorted(range(4), key=lambda i: (-first[i].auc, i))[:2]
    assert [(t.max_depth, t.min_instances) for t in last] == [
        (first[i].max_depth, first[i].min_instances) for i in sorted(best)
    ]
    assert result.best == max(last, key=lambda t: t.auc)
    assert len(fits) == 4 + 2 + 1


@pytest.mark.parametrize("wrong", [{"shares": (1.0, 0.5)}, {"shares": ()}, {"shares": (0.5,)}, {"keep": 0}])
def test_settings_are_checked(transactions, trees, wrong):
    with pytest.raises(ValueError):
        training.tune(transactions, trees, **wrong)
    with pytest.raises(ValueError, match="no points"):
        training.tune(transactions, trees, [])


def test_digest_and_key(spark, transactions):
    digest = data_digest(transactions)
    assert digest == data_digest(transactions.repartition(9).select(*reversed(transactions.columns)))
    assert digest != data_digest(transactions.where("TransactionID <> 17"))
    assert digest != data_digest(transactions.unionAll(transactions.limit(1)))
    assert digest != data_digest(transactions.withColumn("V97", F.col("V97") + 1))
    swapped = [spark.createDataFrame([r], "a int, b int") for r in [(None, 1), (1, None)]]
    assert data_digest(swapped[0]) != data_digest(swapped[1])
    assert data_digest(transactions.limit(0)) == data_digest(transactions.limit(0))
    assert trial_key(digest, 1.0, {"a": 1, "b": 2}) == trial_key(digest, 1.0, {"b": 2, "a": 1})
    assert trial_key(digest, 1.0, {"a": 1}) != trial_key(digest, 0.5, {"a": 1})


def test_the_first_record_of_a_trial_stays(spark, tmp_path):
    store = TrialStore(spark, str(tmp_path / "t"))
    assert store.known() == {}
    store.record("k", {"a": 1}, 1.0, 0.75)
    store.record("k", {"a": 1}, 1.0, 0.5)
    assert store.known() == {"k": 0.75}


def test_the_deepest_points_are_fitted_first(transactions, trees, fits):
    grid = training.parameter_grid(trees, depths=(1, 2, 3), min_instances=(5,))
    result = training.tune(transactions, trees, grid, parallelism=1)
    tried = [p["maxDepth"] for p in fits if p]
    assert tried == [3, 2, 1]
    assert [t.max_depth for t in result.trials] == [1, 2, 3]
