"""Running totals, exact quantiles and exact AUC against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators.evaluation import auc_evaluator, auc_of_groups, exact_auc
from riskweave.operators.quantiles import exact_quantiles
from riskweave.operators.running import running_totals
from tests.plans import no_python_and_no_cross_join


def test_running_totals_over_many_partitions(spark, many_partitions):
    numbers = list(range(500))
    random.Random(1).shuffle(numbers)
    df = spark.createDataFrame([(n, n % 7) for n in numbers], "k int, w int").repartition(6)
    result = running_totals(df, [F.col("k").desc()], {"before": F.col("w"), "place": F.lit(1)})
    assert no_python_and_no_cross_join(result)
    total = 0
    for place, row in enumerate(result.orderBy(F.desc("k")).collect()):
        assert (row["before"], row["place"]) == (total, place)
        total += row["w"]


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "k int")
    assert running_totals(df, [F.col("k")], {"place": F.lit(1)}).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 10, 997])
def test_quantiles(spark, many_partitions, size):
    draw = random.Random(size)
    rows = [
        (
            draw.gauss(0, 1),
            float(draw.randrange(4)),
            5.0 if draw.random() < 0.4 else draw.random() * 10,
            None if draw.random() < 0.3 else float(draw.randrange(10**6)),
            7.0,
        )
        for _ in range(size)
    ]
    names = ["smooth", "few", "hot", "gaps", "constant"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = exact_quantiles(df, names, probabilities)
    for i, name in enumerate(names):
        values = [r[i] for r in rows if r[i] is not None]
        if not values:
            assert found[name] == [None] * len(probabilities)
            continue
        expected = np.quantile(values, probabilities)
        assert found[name] == pytest.approx(list(expected), rel=1e-12, abs=1e-12)


def test_misplaced_brackets_are_widened(spark, monkeypatch):
    from riskweave.operators import quantiles

    monkeypatch.setattr(quantiles, "_SLACK", 0.0)
    monkeypatch.setattr(quantiles, "_SKETCH_ACCURACY", 2)
    values = [float(i * i % 1009) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9])["x"]
    assert found == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])))


@pytest.mark.parametrize("values", [[math.inf] * 4, [-math.inf, 0.0, math.inf], [1.0, math.inf]])
def test_infinite_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_quantiles(df, ["x"], [0.0, 1.0])["x"] == [values[0], values[-1]]
    if len(values) == 4:
        assert exact_quantiles(df, ["x"], [0.3, 0.5])["x"] == [math.inf, math.inf]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def pairs_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_with_ties(spark, many_partitions):
    draw = random.Random(3)
    rows = [(float(draw.randrange(40)), int(draw.random() < 0.2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, isFraud int").repartition(5)
    result = exact_auc(df, "score")
    assert no_python_and_no_cross_join(result)
    assert result.first()["auc"] == pytest.approx(pairs_auc(rows), abs=1e-12)
    evaluated = auc_evaluator(score="score", bins=0).evaluate(df)
    assert evaluated == pytest.approx(pairs_auc(rows), abs=1e-9)


def test_auc_of_one_class_is_unknown(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, isFraud int")
    row = exact_auc(df, "score").first()
    assert row["auc"] is None and row["negatives"] == 2


def test_auc_of_huge_counts_does_not_overflow(spark):
    """Counts of 10^12 on both sides would overflow a 64-bit product."""
    rows = [(0.1, 0, 10**12), (0.2, 10**12, 10**12), (0.3, 10**12, 0)]
    groups = spark.createDataFrame(rows, "score double, pos bigint, neg bigint")
    row = auc_of_groups(groups).first()
    assert row["auc"] == pytest.approx((1.5 + 2) / 4)
    assert (row["positives"], row["negatives"]) == (2 * 10**12, 2 * 10**12)
