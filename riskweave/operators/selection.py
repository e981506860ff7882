"""Choosing caps and features from the data: one or a few aggregates each."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Tail:
    """Upper end of a column: a high quantile, the maximum and the sample deviation."""

    quantile: float | None
    maximum: float | None
    deviation: float | None

    @property
    def is_far(self) -> bool:
        """Whether the maximum is more than a deviation beyond the quantile."""
        known = None not in (self.quantile, self.maximum, self.deviation)
        return known and self.maximum - self.quantile > self.deviation


def tails(
    df: DataFrame, columns: Sequence[str], quantile: float = 0.99, quantile_error: float = 0.0
) -> dict[str, Tail]:
    """The tail of each column over its values, NULL and NaN aside.

    One aggregation for all columns. Exact quantiles take a few more scans; with a
    ``quantile_error`` a sketch of that rank error is part of the one aggregation.
    """
    numbers = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c) for c in columns])
    each = []
    for i, c in enumerate(columns):
        each += [F.max(c).cast("double").alias(f"m{i}"), F.stddev_samp(c).alias(f"d{i}")]
        if quantile_error:
            accuracy = max(1, round(1 / quantile_error))
            each.append(F.percentile_approx(c, quantile, accuracy).cast("double").alias(f"q{i}"))
    row = numbers.agg(*each).first()
    exact = None if quantile_error else exact_quantiles(numbers, columns, [quantile])
    return {
        c: Tail(exact[c][0] if exact else row[f"q{i}"], row[f"m{i}"], row[f"d{i}"])
        for i, c in enumerate(columns)
    }


def fit_cap_thresholds(
    df: DataFrame, columns: Sequence[str], quantile: float = 0.99, only_far: bool = True
) -> dict[str, float | None]:
    """Cap of each column: its exact quantile.

    None for a column without values, and, if ``only_far``, for one whose maximum is
    within a standard deviation of the quantile.
    """
    return {
        c: tail.quantile if tail.is_far or not only_far else None
        for c, tail in tails(df, columns, quantile).items()
    }


def chi_square_table(
    df: DataFrame, features: Sequence[str], label: str = S.LABEL
) -> DataFrame:
    """``feature, categories, dof, chi_square``: independence of each feature and the label.

    NULL is a category; rows without a label do not count. Counts combine map-side, so
    a frequent category shuffles one row per task.
    """
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
        for c in features
    ]
    counts = (
        df.where(F.col(label).isNotNull())
        .select(F.explode(F.array(*cells)).alias("cell"), F.col(label).alias("label"))
        .groupBy("cell.feature", "cell.category")
        .agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # Summed over a feature: (observed - expected)^2 / expected of both labels, where the
    # expected number is n times the label's share of all rows.
    squares = F.sum(F.col("positives").cast("double") * F.col("positives") / F.col("n"))
    positives, rows = F.sum("positives"), F.sum("n")
    share = positives / rows
    spread = F.nullif(share * (1 - share), F.lit(0.0))
    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("categories"),
        (F.count(F.lit(1)) - 1).alias("dof"),
        ((squares - positives * share) / spread).alias("chi_square"),
    )


def chi_square_tail(statistic: float, dof: int) -> float:
    """Probability of a chi-square value of at least ``statistic``.

    The regularised upper incomplete gamma function of dof / 2 and statistic / 2: one
    minus its series near zero, a continued fraction beyond.
    """
    if dof <= 0 or statistic <= 0:
        return 1.0
    a, x = dof / 2, statistic / 2
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    fraction = d
    for i in range(1, 10_000):
        numerator = i * (a - i)
        b += 2
        d = 1 / (numerator * d + b or tiny)
        c = b + numerator / c or tiny
        fraction *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * fraction


def selected_by_step_up(p_values: Sequence[float | None], rate: float) -> list[bool]:
    """Which hypotheses to reject so that the expected share of false ones is at most ``rate``.

    The i-th least of m p-values is compared with i / m of the rate; all up to the
    last one that passes are rejected. None is never rejected but counts in m.
    """
    known = sorted((p, i) for i, p in enumerate(p_values) if p is not None)
    passing = [r for r, (p, _) in enumerate(known, 1) if p <= rate * r / len(p_values)]
    chosen = {i for _, i in known[: max(passing, default=0)]}
    return [i in chosen for i in range(len(p_values))]


def chi_square_selection(
    df: DataFrame, features: Sequence[str], label: str = S.LABEL, false_discoveries: float = 0.05
) -> DataFrame:
    """``chi_square_table`` with ``p_value`` and ``selected``: features that depend on the label.

    The step-up rule keeps the expected share of wrongly selected features within
    ``false_discoveries``, however many features there are. Without both labels the
    statistic and p are NULL. One row per feature passes through the driver.
    """
    rows = sorted(chi_square_table(df, features, label).collect(), key=lambda r: r["feature"])
    tail = [None if r["chi_square"] is None else chi_square_tail(r["chi_square"], r["dof"]) for r in rows]
    chosen = selected_by_step_up(tail, false_discoveries)
    found = [(*r, p, s) for r, p, s in zip(rows, tail, chosen, strict=True)]
    fields = "feature string, categories bigint, dof bigint, chi_square double, p_value double, selected boolean"
    return df.sparkSession.createDataFrame(found, fields)


def dependent_features(
    df: DataFrame, features: Sequence[str], label: str = S.LABEL, false_discoveries: float = 0.05
) -> list[str]:
    """The features to keep, in their given order."""
    table = chi_square_selection(df, features, label, false_discoveries)
    kept = {r["feature"] for r in table.where("selected").collect()}  # features
    return [c for c in features if c in kept]


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``first, second, correlation`` of each pair of columns, from a single scan.

    Rows count where both are given. The pairs are those of the columns, not of rows.
    """
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*cells)).alias("pair")).select("pair.*")


def correlated_features(df: DataFrame, columns: Sequence[str], limit: float = 0.8) -> list[str]:
    """Columns to drop: the later one of each pair correlated beyond ``limit`` either way."""
    pairs = correlation_pairs(df, columns).where(F.abs("correlation") > limit)
    dropped: set[str] = set()
    found = {(r["first"], r["second"]) for r in pairs.collect()}  # pairs of columns
    for first, second in combinations(columns, 2):
        if (first, second) in found and first not in dropped:
            dropped.add(second)
    return [c for c in columns if c in dropped]
