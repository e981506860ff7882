"""Poisson resamples that choose their own cards, and the covariance of two AUCs."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from riskweave.operators import evaluation, ranking
from tests.plans import plan_of

FIELDS = "card1 bigint, max_score double, max_label int"


def brute_weight(seed, card, iteration):
    text = f"{seed}:{'' if card is None else card}:{iteration // 4}"
    digest = hashlib.md5(text.encode()).hexdigest()
    draw = int(digest[8 * (iteration % 4) :][:8], 16)
    total, weight = math.exp(-1), 0
    while draw >= math.floor(total * 2**32):
        weight += 1
        total += math.exp(-1) / math.factorial(weight)
    return weight


def brute_precision(cards, k, iterations, seed):
    def place(card):
        number, score, _ = card
        return (score is None, -(score or 0.0), number is None, number or 0)

    result = []
    for i in range(iterations):
        resample = [c for c in sorted(cards, key=place) for _ in range(brute_weight(seed, c[0], i))]
        result.append(sum(label for _, _, label in resample[:k]) / k)
    return result


def cards_of(n, seed=0):
    draw = np.random.default_rng(seed)
    scores = [None if i % 17 == 0 else float(s) for i, s in enumerate(draw.integers(0, 40, n))]
    return [(None if i == 3 else i, scores[i], int(draw.random() < 0.3)) for i in range(n)]


@pytest.mark.parametrize("n,k,iterations", [(700, 20, 10), (5, 20, 6), (300, 250, 3), (0, 5, 4)])
@pytest.mark.parametrize("parts", [1, 7])
def test_precision_equals_brute_force(spark, n, k, iterations, parts):
    cards = cards_of(n)
    table = spark.createDataFrame(cards, FIELDS).repartition(parts)
    rows = ranking.poisson_bootstrap_precision(table, k, iterations, 9).collect()
    found = {r["iteration"]: r["precision"] for r in rows}
    assert [found[i] for i in range(iterations)] == pytest.approx(brute_precision(cards, k, iterations, 9))


def test_weights_are_poisson():
    weights = ranking.poisson_weights(1, [str(i) for i in range(4000)], 8)
    assert weights.shape == (4000, 8)
    assert weights.mean() == pytest.approx(1, abs=0.02) and weights.var() == pytest.approx(1, abs=0.05)
    shares = np.bincount(weights.ravel(), minlength=4)[:4] / weights.size
    assert shares == pytest.approx([math.exp(-1) / math.factorial(j) for j in range(4)], abs=0.01)


def test_no_more_than_the_best_cards_are_shuffled(spark):
    cards = spark.createDataFrame(cards_of(3000), FIELDS).repartition(3)
    best = ranking._best_of_partition(
        cards.sortWithinPartitions("max_score", ascending=False), "card1", 10, 20, 1
    )
    assert best.count() <= 3 * 20 * 10
    assert "hashpartitioning(iteration" in plan_of(ranking.poisson_bootstrap_precision(cards, 10, 20))


def brute_covariance(rows):
    positive = np.array([r[2] == 1 for r in rows])
    scores = [np.array([r[i] for r in rows], float) for i in (0, 1)]
    parts = []
    for s in scores:
        beats = (s[positive][:, None] > s[~positive]) + 0.5 * (s[positive][:, None] == s[~positive])
        parts.append((beats.mean(axis=1), beats.mean(axis=0)))
    auc = [p[0].mean() for p in parts]
    cov = np.cov(parts[0][0], parts[1][0]) / positive.sum() + np.cov(parts[0][1], parts[1][1]) / (~positive).sum()
    return auc, cov


def test_auc_covariance_equals_all_pairs(spark):
    draw = np.random.default_rng(4)
    rows = [(float(a), float(a // 3 + b), int(a + b > 30 and i % 3 > 0)) for i, (a, b) in enumerate(draw.integers(0, 25, (400, 2)))]
    table = spark.createDataFrame([*rows, (None, 1.0, 1), (1.0, None, 0), (1.0, 1.0, None)], "a double, b double, isFraud int")
    found = evaluation.auc_covariance(table.repartition(5), "a", "b").first()
    auc, cov = brute_covariance(rows)
    assert [found["auc1"], found["auc2"]] == pytest.approx(auc)
    assert [found["var1"], found["covariance"], found["var2"]] == pytest.approx([cov[0, 0], cov[0, 1], cov[1, 1]])
    z = (auc[0] - auc[1]) / math.sqrt(cov[0, 0] + cov[1, 1] - 2 * cov[0, 1])
    assert found["z"] == pytest.approx(z)
    assert (found["positives"], found["negatives"]) == (sum(r[2] for r in rows), 400 - sum(r[2] for r in rows))


def test_equal_scores_and_single_labels(spark):
    rows = [(float(i % 7), float(i % 7), int(i % 5 == 0)) for i in range(100)]
    same = spark.createDataFrame(rows, "a double, b double, isFraud int")
    found = evaluation.auc_covariance(same, "a", "b").first()
    assert found["auc1"] == found["auc2"] and found["z"] is None
    none = evaluation.auc_covariance(same.where("isFraud = 0"), "a", "b").first()
    assert (none["auc1"], none["z"], none["positives"]) == (None, None, 0)
    assert evaluation.auc_covariance(same.limit(0), "a", "b").first()["auc1"] is None


def test_normal_tail():
    assert evaluation.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert math.isnan(evaluation.normal_two_sided(None))
