"""Exact column quantiles by distributed selection.

A sketch brackets each quantile between two values of the column, one pass
counts the values up to each end, and only where a wanted rank falls strictly
between the ends are the values there (a few per mille of the rows) grouped and
put in order. Spark's ``percentile`` would instead hold all distinct values of a
column in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.running import running_totals

_SKETCH_ACCURACY = 1_000
_SLACK = 0.003
# Brackets counted per job: more aggregates than this outgrow generated code.
_BRACKETS_PER_PASS = 24


@dataclass
class _Bracket:
    """Two values around a quantile and the number of values up to each."""

    column: str
    probability: float
    count: int
    low: float
    high: float
    below_low: int = 0
    upto_low: int = 0
    below_high: int = 0
    upto_high: int = 0

    @property
    def position(self) -> float:
        return self.probability * (self.count - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    @property
    def is_wrong(self) -> bool:
        return self.ranks[0] < self.below_low or self.ranks[1] >= self.upto_high

    def end_value(self, rank: int) -> float | None:
        """Value at a rank, or None if it lies strictly between the ends."""
        if rank < self.upto_low:
            return self.low
        return self.high if rank >= self.below_high else None

    @property
    def inside(self) -> int:
        return max(0, self.below_high - self.upto_low)


def _sketch(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> tuple:
    wanted = [max(0.0, p - _SLACK) for p in probabilities]
    wanted += [min(1.0, p + _SLACK) for p in probabilities]
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"n{i}"),
            F.min(c).cast("double").alias(f"min{i}"),
            F.max(c).cast("double").alias(f"max{i}"),
            F.percentile_approx(F.col(c).cast("double"), wanted, _SKETCH_ACCURACY).alias(f"q{i}"),
        ]
    row = df.agg(*aggregates).first()
    brackets, limits = [], {}
    for i, c in enumerate(columns):
        limits[c] = (row[f"min{i}"], row[f"max{i}"])
        if row[f"n{i}"] == 0:
            continue
        for j, p in enumerate(probabilities):
            low, high = row[f"q{i}"][j], row[f"q{i}"][j + len(probabilities)]
            brackets.append(_Bracket(c, p, row[f"n{i}"], low, high))
    return brackets, limits


def _count_brackets(df: DataFrame, brackets: Sequence[_Bracket]) -> None:
    for start in range(0, len(brackets), _BRACKETS_PER_PASS):
        chunk = brackets[start : start + _BRACKETS_PER_PASS]
        counts = []
        for i, b in enumerate(chunk):
            value = F.col(b.column)
            counts += [
                F.count_if(value < b.low).alias(f"below_low{i}"),
                F.count_if(value <= b.low).alias(f"upto_low{i}"),
                F.count_if(value < b.high).alias(f"below_high{i}"),
                F.count_if(value <= b.high).alias(f"upto_high{i}"),
            ]
        row = df.agg(*counts).first()
        for i, b in enumerate(chunk):
            for name in ("below_low", "upto_low", "below_high", "upto_high"):
                setattr(b, name, row[f"{name}{i}"])


def _looked_up(per_bracket: Sequence[int]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in per_bracket]), F.col("bracket"))


def _inner_values(df: DataFrame, brackets: Sequence[_Bracket]) -> dict[tuple[int, int], float]:
    """Values at the ranks that lie between the ends, by (bracket, 0 or 1 for the rank)."""
    cells = []
    for i, b in enumerate(brackets):
        value = F.col(b.column)
        cell = F.struct(F.lit(i).alias("bracket"), value.cast("double").alias("value"))
        cells.append(F.when((value > b.low) & (value < b.high), cell))
    values = (
        df.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = running_totals(values, [F.col("bracket"), F.col("value")], {"before": F.col("n")})

    # A value's rank in its column: its place in the global order, less the
    # values of earlier brackets, plus the values up to the lower end of its own.
    shifts, start = [], 0
    for b in brackets:
        shifts.append(b.upto_low - start)
        start += b.inside
    first = F.col("before") + _looked_up(shifts)
    hits = []
    for side in (0, 1):
        rank = _looked_up([b.ranks[side] for b in brackets])
        hits.append(((first <= rank) & (rank < first + F.col("n"))).alias(f"hit{side}"))
    found = placed.select("bracket", "value", *hits).where("hit0 OR hit1")
    return {
        (row["bracket"], side): row["value"]
        for row in found.collect()  # at most two rows per bracket
        for side in (0, 1)
        if row[f"hit{side}"]
    }


def _between(low: float, high: float, fraction: float) -> float:
    """Interpolated value; an end itself needs no arithmetic, which infinity would spoil."""
    return low if low == high or fraction == 0 else low + (high - low) * fraction


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column over its non-NULL values.

    A few column-pruned scans; only scalars reach the driver. A bracket the
    sketch placed wrongly is widened to the full range of its column.
    """
    df = df.select(*columns)
    brackets, limits = _sketch(df, columns, probabilities)
    _count_brackets(df, brackets)
    wrong = [b for b in brackets if b.is_wrong]
    for b in wrong:
        b.low, b.high = limits[b.column]
    _count_brackets(df, wrong)

    open_brackets = [b for b in brackets if None in map(b.end_value, b.ranks)]
    inner = _inner_values(df, open_brackets) if open_brackets else {}
    result: dict[tuple[str, float], float] = {}
    for b in brackets:
        ends = [b.end_value(rank) for rank in b.ranks]
        for side in (0, 1):
            if ends[side] is None:
                ends[side] = inner[open_brackets.index(b), side]
        fraction = b.position - b.ranks[0]
        result[b.column, b.probability] = _between(*ends, fraction)
    return {c: [result.get((c, p)) for p in probabilities] for c in columns}
