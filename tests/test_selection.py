from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import selection
from riskweave.operators.transformers import OutlierCapEstimator, OutlierCapModel
from riskweave.plans.pipelines import get_feature_extraction_pipeline
from riskweave.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(1000).select(
        (F.col("id") % 97).cast("double").alias("a"),
        (F.col("id") % 97 * -2).cast("double").alias("b"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 11).cast("double").alias("c"),
        F.lit(None).cast("double").alias("d"),
        (F.col("id") % 7 == 0).cast("int").alias("isFraud"),
    )
    return df


def test_caps(data):
    caps = selection.fit_cap_thresholds(data, ["a", "d"], 0.9, only_far=False)
    assert caps == {"a": pytest.approx(np.quantile([i % 97 for i in range(1000)], 0.9)), "d": None}


def test_chi_square_of_a_cause_and_of_a_constant(data):
    cause = data.withColumn("cause", F.col("isFraud"))
    rows = {r["feature"]: r for r in selection.chi_square_table(cause, ["cause", "d"]).collect()}
    assert (rows["cause"]["dof"], rows["d"]["dof"]) == (1, 0)
    assert rows["cause"]["chi_square"] == pytest.approx(1000)
    assert rows["d"]["chi_square"] == pytest.approx(0, abs=1e-9)


def test_correlated_features(data):
    assert selection.correlated_features(data, ["a", "b", "c", "d"]) == ["b"]
    pairs = {(r["first"], r["second"]): r["correlation"] for r in selection.correlation_pairs(data, ["a", "b", "d"]).collect()}
    assert pairs["a", "b"] == pytest.approx(-1) and len(pairs) == 3


@pytest.fixture(scope="module")
def tailed(spark):
    """near: no value beyond the 0.99 quantile by a deviation; far: two of a thousand are."""
    far = F.when(F.col("id") < 2, 10_000.0).otherwise(F.col("id") % 100)
    return spark.range(1000).select(
        "id",
        (F.col("id") % 100).cast("double").alias("near"),
        F.when(F.col("id") % 9 != 5, far).alias("far"),
        F.lit(3.0).alias("constant"),
        F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") == 7, float("nan")).otherwise(F.col("id") % 100).alias("with_nan"),
    )


TAILED = ["near", "far", "constant", "nothing", "with_nan"]


@pytest.mark.parametrize("error", [0.0, 0.001])
def test_only_far_maxima_are_capped(tailed, error):
    found = selection.tails(tailed, TAILED, quantile_error=error)
    assert [c for c in TAILED if found[c].is_far] == ["far"]
    values = np.array([10_000.0 if i < 2 else i % 100 for i in range(1000) if i % 9 != 5])
    assert found["far"].deviation == pytest.approx(values.std(ddof=1))
    assert found["far"].quantile == pytest.approx(np.quantile(values, 0.99), abs=1.0)
    assert found["with_nan"].maximum == 99
    assert found["nothing"] == selection.Tail(None, None, None)


def test_learned_caps_survive_saving(tailed, tmp_path):
    estimator = OutlierCapEstimator(inputCols=TAILED, quantile=0.95)
    estimator.write().save(str(tmp_path / "estimator"))
    loaded = OutlierCapEstimator.load(str(tmp_path / "estimator"))
    model = loaded.fit(tailed)
    assert loaded.getInputCols() == TAILED and list(model.caps()) == ["far"]
    model.write().save(str(tmp_path / "model"))
    again = OutlierCapModel.load(str(tmp_path / "model"))
    assert again.caps() == model.caps()
    capped = again.transform(tailed)
    assert capped.columns == tailed.columns
    assert capped.agg(F.max("far")).first()[0] == model.caps()["far"]
    assert capped.agg(F.max("near"), F.count_if(F.isnan("with_nan"))).first() == (99.0, 1)
    nothing_far = OutlierCapEstimator(inputCols=["near"]).fit(tailed)
    assert nothing_far.caps() == {} and nothing_far.transform(tailed).columns == tailed.columns


def test_pipeline_that_learns_caps(transactions, tmp_path):
    model = get_feature_extraction_pipeline(learn_caps=True).fit(transactions)
    save_model(model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m"))
    caps = selection.fit_cap_thresholds(transactions, S.CONTINUOUS_FEATURES)
    assert loaded.stages[1].caps() == {c: v for c, v in caps.items() if v is not None}
    rows = [m.transform(transactions).select("features").collect() for m in (model, loaded)]
    assert rows[0] == rows[1] and len(rows[0]) == transactions.count()


@pytest.mark.parametrize(
    "statistic,dof,p",
    [
        # Published critical values of the chi-square distribution.
        (3.841458820694124, 1, 0.05),
        (6.634896601021213, 1, 0.01),
        (5.991464547107979, 2, 0.05),
        (18.307038053275146, 10, 0.05),
        (124.34211340400408, 100, 0.05),
        (70.06489492539978, 100, 0.99),
        (0.0, 3, 1.0),
        (5.0, 0, 1.0),
    ],
)
def test_chi_square_tail(statistic, dof, p):
    assert selection.chi_square_tail(statistic, dof) == pytest.approx(p, rel=1e-9)


def test_chi_square_tail_has_closed_forms():
    for x in (0.01, 0.5, 1.9, 2.1, 7.0, 60.0, 400.0):
        assert selection.chi_square_tail(x, 2) == pytest.approx(np.exp(-x / 2), rel=1e-11)
        assert selection.chi_square_tail(x, 4) == pytest.approx(np.exp(-x / 2) * (1 + x / 2), rel=1e-11)
    assert selection.chi_square_tail(5000.0, 3) == 0.0


def test_step_up():
    assert selection.selected_by_step_up([0.04, 0.03, 0.9, None], 0.05) == [False] * 4
    # 0.02 alone fails 0.05 / 3, but 0.03 passes 2 / 3 of it and takes 0.02 along
    assert selection.selected_by_step_up([0.02, 0.03, 0.9], 0.05) == [True, True, False]
    assert selection.selected_by_step_up([0.9, 0.001], 0.05) == [False, True]
    assert selection.selected_by_step_up([], 0.05) == []


def test_selected_features(data):
    """Of a cause of the label, noise and a constant only the cause is kept."""
    cause = data.withColumn("cause", F.col("isFraud"))
    assert selection.dependent_features(cause, ["c", "cause", "d"]) == ["cause"]
    one_label = selection.chi_square_selection(cause.where("isFraud = 0"), ["c", "cause"]).collect()
    assert [(r["chi_square"], r["p_value"], r["selected"]) for r in one_label] == [(None, None, False)] * 2


def test_correlation_limit_is_four_fifths(spark):
    x = F.col("id") % 100
    mixed = spark.range(1000).select(x.cast("double").alias("x"), (x + F.col("id") * 7 % 50).cast("double").alias("y"))
    correlation = selection.correlation_pairs(mixed, ["x", "y"]).first()["correlation"]
    assert 0.8 < abs(correlation) < 0.95
    assert selection.correlated_features(mixed, ["x", "y"]) == ["y"]
