"""Card-level precision among the k riskiest cards, with bootstrap resamples."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schema as S
from riskweave.functions.expressions import positive_probability
from riskweave.functions.hashing import resample_index
from riskweave.operators.joins import measure, sized_join
from riskweave.sources.workspace import settle


def card_max_scores(
    scored: DataFrame, score: str = "prob_flag", label: str = S.LABEL, card: str = S.CARD
) -> DataFrame:
    """Highest score and label of each card; rows without a card form one group.

    Both maxima combine map-side, so a hot card shuffles one row per task.
    """
    return scored.groupBy(card).agg(
        F.max(score).alias("max_score"), F.max(label).alias("max_label")
    )


def top_k_cards(cards: DataFrame, k: int = 50, card: str = S.CARD) -> DataFrame:
    """The k cards with the highest score and their position from 0; ties by card."""
    order = [F.col("max_score").desc_nulls_last(), F.col(card).asc_nulls_last()]
    top = cards.orderBy(*order).limit(k)  # TakeOrderedAndProject: k rows remain
    position = F.row_number().over(Window.orderBy(*order)) - 1
    return top.select(card, "max_score", "max_label", position.alias("position"))


def precision_at_k(top: DataFrame, k: int = 50, shrink: bool = False) -> DataFrame:
    """One row: cards found, frauds among them and precision.

    The denominator is k even when there are fewer cards; ``shrink`` uses the
    number of cards instead.
    """
    found, frauds = F.count(F.lit(1)), F.coalesce(F.sum("max_label"), F.lit(0))
    return top.agg(
        found.alias("cards"),
        frauds.alias("frauds"),
        (frauds / (found if shrink else F.lit(k))).alias("precision"),
    )


def bootstrap_draws(top: DataFrame, iterations: int = 100, seed: int = 25) -> DataFrame:
    """``iteration, draw, position, label``: resamples with replacement of the top cards.

    The draws are a range over many partitions, joined to the measured top cards.
    """
    labels = settle(top.select("position", F.col("max_label").alias("label")))
    size = measure(labels)
    session = top.sparkSession
    partitions = max(2, int(session.conf.get("spark.sql.shuffle.partitions")))
    numbers = session.range(0, iterations * size.rows, 1, partitions)
    cards = F.lit(max(1, size.rows))
    drawn = numbers.select(
        F.floor(F.col("id") / cards).cast("int").alias("iteration"),
        (F.col("id") % cards).cast("int").alias("draw"),
        F.col("id").alias("_draw"),
    ).withColumn(
        "position", resample_index(seed, F.col("iteration"), F.col("draw"), cards).cast("int")
    )
    joined = sized_join(drawn, labels, "position", "inner", size, salt_by=["_draw"])
    return joined.select("iteration", "draw", "position", "label")


def bootstrap_precision(
    top: DataFrame,
    k: int = 50,
    iterations: int = 100,
    seed: int = 25,
    output: str = "precision",
) -> DataFrame:
    """``iteration`` and the precision of its resample."""
    draws = bootstrap_draws(top, iterations, seed)
    return draws.groupBy("iteration").agg((F.sum("label") / F.lit(k)).alias(output))


def poisson_thresholds() -> list[int]:
    """Bounds of a 32-bit draw: as many are at or below it as its Poisson(1) weight."""
    bounds, total, weight = [], 0.0, 0
    while (bound := math.floor((total := total + math.exp(-1) / math.factorial(weight)) * 2**32)) < 2**32 - 1:
        bounds.append(bound)
        weight += 1
    return bounds


def poisson_weights(seed: int, cards: list[str | None], iterations: int) -> np.ndarray:
    """How often each card is in each resample: a row per card, from MD5 of seed, card and block.

    One digest gives the draws of four iterations.
    """
    blocks = range(-(-iterations // 4))
    texts = (f"{seed}:{card or ''}:{block}".encode() for card in cards for block in blocks)
    digests = b"".join(hashlib.md5(t, usedforsecurity=False).digest() for t in texts)
    draws = np.frombuffer(digests, ">u4").reshape(len(cards), -1)[:, :iterations]
    return np.searchsorted(np.array(poisson_thresholds(), np.int64), draws.astype(np.int64), side="right")


def _best_of_partition(cards: DataFrame, card: str, k: int, iterations: int, seed: int) -> DataFrame:
    """For each resample, the best cards of each partition that make up k, and their weights.

    Rows come in order, so a resample is complete once its weights reach k; after a
    few hundred cards all are, and the rest of the partition is only read. Such lists
    merge: the best k of all partitions are among the best k of each.
    """
    fields = [T.StructField("iteration", T.IntegerType()), T.StructField("weight", T.IntegerType())]

    def run(batches):
        reached = np.zeros(iterations, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                wanted = np.flatnonzero(reached < k)
                if not len(wanted):
                    break
                piece = batch.slice(at, 128)
                names = [None if c is None else str(c) for c in piece.column(card).to_pylist()]
                weights = poisson_weights(seed, names, iterations)
                before = reached + np.cumsum(weights, axis=0) - weights
                rows, drawn = np.nonzero((weights > 0) & (before < k))
                reached += weights.sum(axis=0)
                columns = [pa.array(drawn, pa.int32()), pa.array(weights[rows, drawn], pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    columns + piece.take(pa.array(rows)).columns,
                    names=["iteration", "weight", *piece.schema.names],
                )

    return cards.mapInArrow(run, T.StructType(fields + cards.schema.fields))


def poisson_bootstrap_precision(
    cards: DataFrame,
    k: int = 50,
    iterations: int = 100,
    seed: int = 25,
    card: str = S.CARD,
    output: str = "precision",
) -> DataFrame:
    """``iteration`` and the precision of the k riskiest cards of its resample of all cards.

    Unlike ``bootstrap_precision``, which resamples the cards chosen once, every
    resample chooses its own: a card counts as often as its Poisson(1) weight says, and
    the last one chosen only up to k. One scan; at most ``iterations`` x k rows a
    partition are shuffled. Ties go to the lower card; precision divides by k even if a
    resample has fewer cards.
    """
    order = [F.col("max_score").desc_nulls_last(), F.col(card).asc_nulls_last()]
    ordered = cards.select(card, "max_score", "max_label").sortWithinPartitions(*order)
    best = _best_of_partition(ordered, card, k, iterations, seed)
    earlier = Window.partitionBy("iteration").orderBy(*order)
    before = F.coalesce(
        F.sum("weight").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    counted = best.withColumn("_before", before).where(F.col("_before") < k)
    units = F.least(F.col("weight"), F.lit(k) - F.col("_before"))
    found = counted.groupBy("iteration").agg((F.sum(units * F.col("max_label")) / F.lit(k)).alias(output))
    every = cards.sparkSession.range(iterations).select(F.col("id").cast("int").alias("iteration"))
    precision = F.coalesce(output, F.lit(0.0)).alias(output)
    return every.join(F.broadcast(found), "iteration", "left").select("iteration", precision)


def bootstrap_summary(scores: DataFrame, column: str = "precision") -> DataFrame:
    """Mean, sample deviation and three-deviation band of the resampled precision."""
    mean, deviation = F.avg(column), F.stddev_samp(column)
    return scores.agg(
        F.count(column).alias("iterations"),
        mean.alias("mean"),
        deviation.alias("std"),
        (mean - 3 * deviation).alias("low"),
        (mean + 3 * deviation).alias("high"),
    )


def get_cards_precision_top_k(
    predictions: DataFrame,
    k: int = 50,
    bootstrap_iterations: int = 100,
    seed: int = 25,
) -> DataFrame:
    """Bootstrapped precision of a scored data set: ``iteration, precision_top_<k>``."""
    scored = predictions.select(
        S.CARD, positive_probability(F.col("probability")).alias("prob_flag"), S.LABEL
    )
    top = top_k_cards(card_max_scores(scored), k)
    return bootstrap_precision(top, k, bootstrap_iterations, seed, f"precision_top_{k}")
