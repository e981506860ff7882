"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

The labelled texts give each hashed n-gram the log of its smoothed share among
toxic texts over that among others. An n-gram that occurs in a text enters the
linear model with this ratio as its value, however often it occurs. The less its counts
differ from those that chance would give, the smaller the value: so weak n-grams weigh
little where there are strong ones, and count where labels are few and none is strong.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import (
    add_columns,
    is_held_out,
    keep_rows,
    labelled_sample,
    slices,
)
from riskweave.sources.workspace import settle

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
MOST_LABELLED = 20_000  # bound on the rows the model is fitted on
BUCKETS = 1 << 20
LENGTHS = (4, 5, 6)
MOST_FEATURES = 8192  # size of the model: n-grams of the most evidence
HALF_EVIDENCE = 15.0  # likelihood ratio statistic at which an n-gram is trusted by half
_CHUNK = 1 << 20


def gram_buckets(text: str):
    """Buckets of all character n-grams of ``text`` in lower case, in blocks."""
    text = f" {text.lower()} "
    overlap = max(LENGTHS) - 1
    for at in range(0, max(1, len(text) - overlap), _CHUNK):
        piece = text[at : at + _CHUNK + overlap].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(piece, np.uint32)
        for length in LENGTHS:
            count = len(codes) - length + 1
            if count <= 0:
                continue
            value = np.full(count, length, np.uint32)
            for i in range(length):
                value *= np.uint32(0x01000193)
                value ^= codes[i : i + count]
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            value ^= value >> np.uint32(12)
            value *= np.uint32(0x297A2D39)
            value ^= value >> np.uint32(15)
            yield value & np.uint32(BUCKETS - 1)


def _distinct(text: str | None, chosen: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of a text, among the chosen only where these are given."""
    blocks = [np.empty(0, np.uint32)]
    for buckets in gram_buckets(text or ""):
        blocks.append(buckets if chosen is None else buckets[chosen[buckets]])
    return np.unique(np.concatenate(blocks))


def trusted(ratios: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """Ratios, smaller the more likely chance is: half at ``HALF_EVIDENCE``, and to the
    fourth power less below it."""
    return ratios * evidence**4 / (evidence**4 + HALF_EVIDENCE**4)


def gram_ratios(
    sample: DataFrame, most: int = MOST_FEATURES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the most evidence, at most ``most``, their log-count ratios and evidence."""

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        for part in slices(batches):
            for text, target in zip(
                part.column("text").to_pylist(), part.column("target").to_pylist(), strict=True
            ):
                sums[target, _distinct(text)] += 1
        seen = np.flatnonzero(sums.any(axis=0))
        for at in range(0, len(seen), 100_000):
            own = seen[at : at + 100_000]
            columns = [pa.array(own.astype(np.int32)), *map(pa.array, sums[::-1, own])]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "pos", "neg"])

    counts = (
        sample.select("text", F.col("target").cast("int").alias("target"))
        .mapInArrow(count, "bucket int, pos bigint, neg bigint")
        .groupBy("bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    texts = sample.agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")
    ).first()
    share = lambda c: (F.col(c) + 1) / F.lit(texts[c] + 2.0)
    ratio = F.log(share("pos") / share("neg"))
    both, every = F.col("pos") + F.col("neg"), texts["pos"] + texts["neg"]

    def surprise(c: str) -> Column:
        expected = both * (texts[c] / max(1, every))
        return F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / expected)).otherwise(0.0)

    evidence = 2 * (surprise("pos") + surprise("neg"))
    rows = (
        counts.select("bucket", ratio.alias("ratio"), evidence.alias("weight"))
        .where(F.col("weight") > 1e-9)
        .orderBy(F.desc("weight"), "bucket")
        .limit(most)
        .toArrow()
    )
    rows = rows.sort_by("bucket")
    return tuple(rows[c].to_numpy() for c in ("bucket", "ratio", "weight"))


@dataclass
class ToxicityModel:
    """Bias, chosen buckets in order, and for each the weight times its log-count ratio."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        chosen = np.zeros(BUCKETS, bool)
        chosen[self.buckets] = True
        weight = np.zeros(BUCKETS)
        weight[self.buckets] = self.weights
        return chosen, weight


def _fit_linear(
    rows: np.ndarray, columns: np.ndarray, ratios: np.ndarray, targets: np.ndarray, penalty: float
) -> tuple[float, np.ndarray]:
    """Logistic regression on present features valued by their ratios; fixed full-batch steps."""
    n, k = len(targets), len(ratios)
    values = ratios[columns]
    weights, bias = np.zeros(k), 0.0
    mean, square = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, 401):
        margin = bias + np.bincount(rows, values * weights[columns], n)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - targets) / n
        slope = np.bincount(columns, values * error[rows], k) + penalty * weights / n
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= move[:k]
        bias -= move[k]
    return float(bias), weights * ratios


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, most_rows: int = MOST_LABELLED, penalty: float = 1.0
) -> ToxicityModel:
    """A model fitted on at most ``most_rows`` labelled documents outside the held-out fold.

    N-grams are counted by the executors; only the chosen ones of each of these
    documents reach the driver. Without labels of both kinds all texts score 0.
    """
    sample = settle(labelled_sample(docs, labels, "toxic", MODULUS, HELD_OUT, most_rows))
    kinds = {row["target"] for row in sample.select("target").distinct().collect()}
    if not {0, 1} <= kinds:
        return ToxicityModel(-30.0, np.empty(0, np.int64), np.empty(0))
    buckets, ratios, evidence = gram_ratios(sample.where(F.col("target").isin(0, 1)))
    table = np.zeros(BUCKETS, bool)
    table[buckets] = True
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def start():
        chosen = shared.value
        return lambda part: [[_distinct(t, chosen) for t in part.column("text").to_pylist()]]

    found = add_columns(sample, "buckets array<int>", start)
    found = found.select("doc_id", "target", "buckets").toArrow().sort_by("doc_id")
    own = [x.values.to_numpy() for x in found["buckets"]]
    rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
    columns = np.searchsorted(buckets, np.concatenate(own))
    targets = found["target"].to_numpy().astype(float)
    bias, weights = _fit_linear(rows, columns, trusted(ratios, evidence), targets, penalty)
    return ToxicityModel(bias, buckets, weights)


def _scorer(docs: DataFrame, model: ToxicityModel):
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, *model.tables()))

    def start():
        bias, chosen, weight = shared.value

        def score(part):
            margins = [
                bias + weight[_distinct(t, chosen)].sum() for t in part.column("text").to_pylist()
            ]
            return [float(1 / (1 + np.exp(-np.clip(m, -30, 30)))) for m in margins]

        return score

    return start


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    NULL and empty texts have no n-gram and get the score of the bias alone.
    Rows without doc_id are scored and not held out; repeated rows come back
    repeated; an empty table gives no rows; other columns are ignored.
    """
    begin = _scorer(docs, model)

    def start():
        score = begin()

        def work(part):
            scores = score(part)
            return [scores, [int(s >= threshold) for s in scores]]

        return work

    held_out = is_held_out(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out")
    scored = add_columns(docs.select("doc_id", "text"), "score double, predicted int", start)
    return scored.select("doc_id", held_out, "score", "predicted")


def without_toxic(
    docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """Rows scored below ``threshold``, with all their columns."""
    begin = _scorer(docs, model)

    def start():
        score = begin()
        return lambda part: [s < threshold for s in score(part)]

    return keep_rows(docs, start)
