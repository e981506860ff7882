"""Fitted statistics that grow by parts: each part is read once, states are added.

A state holds, for each feature and bucket of values, how many there are, the least and
the greatest. Bucket bounds grow by ``2 ** (1 / FINENESS)``, whatever the data, so states
of different parts add up exactly: minimum, maximum and counts are those of all rows.
The value at any rank lies between the least and greatest of the bucket that holds the
rank, at most ``RELATIVE_ERROR`` from either; buckets of one value are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources import commits

FINENESS = 64
RELATIVE_ERROR = 2 ** (1 / FINENESS) - 1
_ONE = 1100 * FINENESS  # the bucket of 1.0: even the least double is in a positive one
_ENDLESS = 2 * _ONE + FINENESS
STATE = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
    ]
)


def bucket_of(value: Column) -> Column:
    """Rises with the value; NULL has none, NaN the one above infinity."""
    size = F.abs(value)
    step = F.when(size == float("inf"), _ENDLESS).otherwise(
        F.floor(F.log2(size) * FINENESS).cast("int") + _ONE
    )
    signed = F.when(value < 0, -step).otherwise(step)
    return (
        F.when(value.isNull(), None)
        .when(F.isnan(value), _ENDLESS + 1)
        .when(value == 0, 0)
        .otherwise(signed)
        .cast("int")
    )


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("feature", "bucket").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def fit_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The state of one part: one scan, combined before the shuffle."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    cells = values.unpivot([], list(columns), "feature", "value")
    one = F.lit(1).cast("bigint")
    value = F.col("value")
    return _added(
        cells.select("feature", bucket_of(value).alias("bucket"), one.alias("n"), value.alias("low"), value.alias("high"))
    )


def add_part(df: DataFrame, columns: Sequence[str], path: str, part: int) -> bool:
    """Commit the state of one part, once; False if it was there."""
    return commits.commit(fit_state(df, columns), path, part, "state")


def folded(spark: SparkSession, path: str) -> DataFrame:
    """The state of all committed parts together."""
    return _added(commits.read_committed(spark, path, STATE))


def counts_and_limits(state: DataFrame) -> DataFrame:
    """``feature, n, missing, low, high``; a feature without values has no limits."""
    known = F.col("bucket").isNotNull()
    return state.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def min_max_of(state: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """What ``encoding.fit_min_max`` finds in all rows."""
    return {r["feature"]: (r["low"], r["high"]) for r in counts_and_limits(state).collect()}


def _at(rank: int, row) -> float:
    """The value at a rank within its bucket, exact at both ends."""
    place = rank - row["before"]
    if place == 0 or row["low"] == row["high"]:
        return row["low"]
    if place == row["n"] - 1:
        return row["high"]
    return row["low"] + (row["high"] - row["low"]) * (place / (row["n"] - 1))


def quantiles_of(
    state: DataFrame, probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each feature, within ``RELATIVE_ERROR`` of the value.

    A feature has a bounded number of buckets, so it is ordered in one task; the
    driver gets two rows for each quantile.
    """
    totals = {r["feature"]: r["n"] for r in counts_and_limits(state).collect()}
    order = Window.partitionBy("feature").orderBy("bucket")
    before = F.sum("n").over(order) - F.col("n")
    placed = state.where("bucket IS NOT NULL").withColumn("before", before)
    wanted = [
        (feature, rank)
        for feature, n in totals.items()
        for p in probabilities
        for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}
        if n
    ]
    spark = state.sparkSession
    ranks = spark.createDataFrame(wanted, "feature string, rank bigint").distinct()
    found = placed.join(F.broadcast(ranks), "feature").where(
        "before <= rank AND rank < before + n"
    )
    values = {(r["feature"], r["rank"]): _at(r["rank"], r) for r in found.collect()}

    def quantile(feature: str, n: int, p: float) -> float | None:
        if not n:
            return None
        position = p * (n - 1)
        low = values[feature, math.floor(position)]
        high = values[feature, math.ceil(position)]
        part = position - math.floor(position)
        return low if low == high or part == 0 else low + (high - low) * part

    return {f: [quantile(f, n, p) for p in probabilities] for f, n in totals.items()}
