"""ROC AUC, the covariance of two of them, and the two-sample t-test."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.joins import measure, sized_join
from riskweave.operators.running import running_totals
from riskweave.sources.workspace import settle


def auc_evaluator(
    label: str = S.LABEL, score: str = "rawPrediction", bins: int = 1000
) -> BinaryClassificationEvaluator:
    """Area under ROC from a curve of about ``bins`` points (0: every distinct score)."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    )


def exact_auc(scored: DataFrame, score: str, label: str = S.LABEL) -> DataFrame:
    """One row ``auc, positives, negatives``: the share of (positive, negative) pairs
    ranked rightly, ties counting half.

    Rows collapse to one per distinct score before anything is ordered. Counts
    are summed as integers, so the result does not depend on summation order.
    """
    is_positive = F.col(label) == 1
    groups = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )
    return auc_of_groups(groups)


def auc_of_groups(groups: DataFrame) -> DataFrame:
    """``exact_auc`` from the positives and negatives of each distinct score."""
    placed = running_totals(groups, [F.col("score").asc_nulls_first()], {"below": F.col("neg")})
    wins = F.col("pos").cast("decimal(18,0)") * (2 * F.col("below") + F.col("neg")).cast(
        "decimal(20,0)"
    )
    positives, negatives = F.sum("pos"), F.sum("neg")
    pairs = 2.0 * positives.cast("double") * negatives.cast("double")
    return placed.agg(
        (F.sum(wins).cast("double") / F.nullif(pairs, F.lit(0.0))).alias("auc"),
        positives.alias("positives"),
        negatives.alias("negatives"),
    )


def _placements(cells: DataFrame, score: str, all_positives: int, name: str) -> DataFrame:
    """Per distinct score, twice the negatives below and the positives above it, ties half."""
    groups = cells.groupBy(score).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    placed = running_totals(
        groups, [F.col(score)], {"neg_below": F.col("neg"), "pos_below": F.col("pos")}
    )
    above = F.lit(all_positives) - F.col("pos_below") - F.col("pos")
    return placed.select(
        score,
        (2 * F.col("neg_below") + F.col("neg")).alias(f"below{name}"),
        (2 * above + F.col("pos")).alias(f"above{name}"),
    )


def auc_covariance(scored: DataFrame, first: str, second: str, label: str = S.LABEL) -> DataFrame:
    """One row: the AUC of two scores of the same rows, their variances and covariance, and z.

    A positive's placement is the share of negatives below it, a negative's that of
    positives above it. AUC is the mean placement, and the covariance of two AUCs that
    of their placements among positives over their number, plus the same for negatives.
    ``z`` is the difference over its standard error. Rows collapse to one per pair of
    scores and placements are running totals, so nothing is ordered in one task. Rows
    without a score or label do not count; z is NULL where the difference has no variance.
    """
    is_positive = F.col(label) == 1
    cells = settle(
        scored.where(F.col(first).isNotNull() & F.col(second).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(first).alias("s1"), F.col(second).alias("s2"))
        .agg(F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg"))
    )
    totals = cells.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("m"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n")
    ).first()
    m, n = totals["m"], totals["n"]
    joined = cells
    for score, name in (("s1", "1"), ("s2", "2")):
        placed = settle(_placements(cells, score, m, name))
        joined = sized_join(joined, placed, score, "inner", measure(placed), salt_by=["s1", "s2"])

    def moments(kind: str, of: str) -> list:
        a, b, c = F.col(f"{kind}1"), F.col(f"{kind}2"), F.col(of)
        exact = lambda x: F.sum((x * c).cast("decimal(38,0)")).cast("double")
        wide = lambda x: x.cast("decimal(18,0)")
        pairs = {"x": a, "y": b, "xx": wide(a) * wide(a), "yy": wide(b) * wide(b), "xy": wide(a) * wide(b)}
        return [exact(value).alias(f"{kind}_{p}") for p, value in pairs.items()]

    sums = joined.agg(*moments("below", "pos"), *moments("above", "neg"))

    def covariance(pair: str) -> Column:
        """Of the placements, over the number of rows, for both labels together."""
        total = F.lit(0.0)
        for kind, rows, others in (("below", m, n), ("above", n, m)):
            mean = F.col(f"{kind}_{pair[0]}") * F.col(f"{kind}_{pair[1]}") / F.lit(float(rows or 1))
            spread = (F.col(f"{kind}_{pair}") - mean) / F.lit(float(rows - 1)) if rows > 1 else F.lit(None)
            total = total + spread / F.lit(4.0 * (others or 1) ** 2 * (rows or 1))
        return total

    auc = lambda p: F.col(f"below_{p}") / F.nullif(F.lit(2.0 * m * n), F.lit(0.0))
    row = sums.select(
        auc("x").alias("auc1"),
        auc("y").alias("auc2"),
        covariance("xx").cast("double").alias("var1"),
        covariance("yy").cast("double").alias("var2"),
        covariance("xy").cast("double").alias("covariance"),
    )
    spread = F.col("var1") + F.col("var2") - 2 * F.col("covariance")
    z = F.when(spread > 1e-18, (F.col("auc1") - F.col("auc2")) / F.sqrt(spread))
    return row.select("*", z.alias("z"), F.lit(m).alias("positives"), F.lit(n).alias("negatives"))


def normal_two_sided(z: float | None) -> float:
    """Probability of a standard normal value at least as far from zero."""
    return math.nan if z is None else math.erfc(abs(z) / math.sqrt(2))


def pooled_t_statistic(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    """One row: sizes, means and variances of two samples, Student's t with pooled
    variance and its degrees of freedom. A zero variance gives t = NULL.
    """
    both = first.select(F.lit(True).alias("is_first"), F.col(column).alias("x")).unionByName(
        second.select(F.lit(False).alias("is_first"), F.col(column).alias("x"))
    )
    x1, x2 = F.when(F.col("is_first"), F.col("x")), F.when(~F.col("is_first"), F.col("x"))
    stats = both.agg(
        F.count(x1).alias("n1"),
        F.count(x2).alias("n2"),
        F.avg(x1).alias("mean1"),
        F.avg(x2).alias("mean2"),
        F.var_samp(x1).alias("var1"),
        F.var_samp(x2).alias("var2"),
    )
    dof = F.col("n1") + F.col("n2") - 2
    squares = (F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2")
    error = F.sqrt(squares / dof * (1 / F.col("n1") + 1 / F.col("n2")))
    t = (F.col("mean1") - F.col("mean2")) / F.nullif(error, F.lit(0.0))
    return stats.select("*", t.alias("t"), dof.alias("dof"))


@dataclass(frozen=True)
class TTest:
    t: float
    dof: int
    p_value: float


def t_test_less(first: DataFrame, second: DataFrame, column: str) -> TTest:
    """Test of mean(first) < mean(second) with equal variances.

    Without any variance the means alone decide; equal means give NaN.
    """
    row = pooled_t_statistic(first, second, column).first()
    t = row["t"]
    if t is None:
        gap = (row["mean1"] or 0.0) - (row["mean2"] or 0.0)
        t = math.copysign(math.inf, gap) if gap else math.nan
    return TTest(t, row["dof"], student_t_cdf(t, row["dof"]))


def student_t_cdf(t: float, dof: int) -> float:
    if math.isnan(t) or dof <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0 if t < 0 else 1.0
    tail = 0.5 * _incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))
    return tail if t <= 0 else 1.0 - tail


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    log_front += a * math.log(x) + b * math.log1p(-x)
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
    fraction = d
    for m in range(1, 1000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / (1.0 + term * d or tiny)
            c = 1.0 + term / c or tiny
            step = c * d
            fraction *= step
        if abs(step - 1.0) < 1e-15:
            break
    return math.exp(log_front) * fraction / a
