"""Document quality by a factorisation machine.

Inputs are the hashed words of a text, its structure statistics in bins and its
declared length. The machine gives each input a weight and a vector of ``RANK``
numbers; a pair of inputs counts by the product of their vectors. By the
sum-of-squares identity the sum over all pairs takes time linear in the inputs:
half the squared norm of the summed vectors, less the sum of their squared norms.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, is_held_out, labelled_sample, utf8

MODULUS, HELD_OUT = 5, 0
THRESHOLD = 0.3
MOST_LABELLED = 8000  # bound on the rows the model is fitted on
WORDS = 1 << 16
RANK = 8
BINS = 12
_SYMBOLS = b"#*$%&|<>"
_STATISTICS = 12
SIZE = WORDS + _STATISTICS * BINS


def _bin(value: float, most: float) -> int:
    return min(BINS - 1, int(value / most * BINS))


def statistics(text: bytes, words: list[bytes], declared: int | None) -> list[int]:
    """One bin for each statistic of structure, and two of metadata."""
    size, count = max(1, len(text)), max(1, len(words))
    without = lambda chars: size - len(text.translate(None, chars))
    upper, lower = (without(bytes(range(a, a + 26))) for a in (0x41, 0x61))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    characters = len(text.translate(None, bytes(range(0x80, 0xC0))))  # no continuation bytes
    if declared is None:
        agrees = 0
    else:
        agrees = 1 if declared == characters else 2
    return [
        _bin(without(_SYMBOLS) / count, 1.5),
        _bin(upper / max(1, upper + lower), 1.0),
        _bin(without(b"!") / count, 1.0),
        _bin(without(b"|") / count, 1.0),
        _bin(len(set(words)) / count, 1.0),
        _bin(repeats / count, 1.0),
        _bin(sum(map(len, words)) / count, 24.0),
        _bin(without(b"0123456789") / size, 0.5),
        _bin(without(b".,;:?") / count, 1.0),
        _bin(np.log2(1 + without(b"\n") / count * 64), 8.0),
        _bin(np.log2(1 + (declared or 0)), 20.0),
        agrees,
    ]


def features(text: bytes | None, declared: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the inputs; words share a norm of one, statistics have one each."""
    text = text or b""
    words = text.lower().split()
    bins = np.array(statistics(text, text.split(), declared)) + BINS * np.arange(_STATISTICS)
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (WORDS - 1)
    indices, counts = np.unique(hashes, return_counts=True)
    values = np.log1p(counts)
    values /= max(1e-9, np.sqrt((values * values).sum()))
    return (
        np.concatenate([indices, bins + WORDS]),
        np.concatenate([values, np.full(_STATISTICS, 1.0)]),
    )


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, seed: int = 7) -> FactorisationMachine:
        vectors = np.random.default_rng(seed).normal(0, 0.02, (SIZE, RANK))
        return cls(0.0, np.zeros(SIZE), vectors)

    def margin(self, indices: np.ndarray, values: np.ndarray) -> float:
        scaled = self.vectors[indices] * values[:, None]
        total = scaled.sum(axis=0)
        pairs = 0.5 * float(total @ total - np.einsum("ij,ij->", scaled, scaled))
        return float(self.bias + self.weights[indices] @ values + pairs)

    def score(self, indices: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(indices, values), -30, 30))))

    def fit(self, rows: list[tuple], epochs: int = 4, rate: float = 0.1, decay: float = 1e-4) -> None:
        """Stochastic gradient steps of the log loss, scaled per parameter by past gradients."""
        past_w, past_v = np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2)
        past_b = 1e-2
        order = np.random.default_rng(11)
        for _ in range(epochs):
            for row in order.permutation(len(rows)):
                target, indices, values = rows[row]
                error = self.score(indices, values) - target
                held = self.vectors[indices]
                total = values @ held
                slope_w = error * values + decay * self.weights[indices]
                slope_v = error * values[:, None] * (total - held * values[:, None]) + decay * held
                past_w[indices] += slope_w * slope_w
                past_v[indices] += slope_v * slope_v
                past_b += error * error
                self.weights[indices] -= rate * slope_w / np.sqrt(past_w[indices])
                self.vectors[indices] -= rate * slope_v / np.sqrt(past_v[indices])
                self.bias -= rate * error / np.sqrt(past_b)


def _declared(docs: DataFrame) -> DataFrame:
    """doc_id, text and n_chars; NULL where the table has no such number."""
    kinds = {name.lower(): kind for name, kind in docs.dtypes}
    numeric = kinds.get("n_chars") in ("bigint", "int", "smallint", "tinyint")
    n_chars = F.col("n_chars").cast("bigint") if numeric else F.lit(None).cast("bigint")
    return docs.select("doc_id", "text", n_chars.alias("n_chars"))


def fit_quality(
    docs: DataFrame, labels: DataFrame, most_rows: int = MOST_LABELLED
) -> FactorisationMachine:
    """A machine fitted on at most ``most_rows`` labelled documents outside the held-out fold.

    Their inputs are computed by the executors. Without labelled documents the
    machine scores each text about 0.5.
    """
    sample = labelled_sample(
        _declared(docs), labels, "quality", MODULUS, HELD_OUT, most_rows, extra=["n_chars"]
    )

    def start():
        def work(part):
            found = [
                features(text, declared)
                for text, declared in zip(utf8(part), part.column("n_chars").to_pylist(), strict=True)
            ]
            return [[i for i, _ in found], [v for _, v in found]]

        return work

    inputs = add_columns(sample, "indices array<int>, amounts array<float>", start)
    table = inputs.select("doc_id", "target", "indices", "amounts").toArrow().sort_by("doc_id")
    rows = [
        (target, indices.values.to_numpy().astype(np.int64), amounts.values.to_numpy().astype(float))
        for target, indices, amounts in zip(
            table["target"].to_pylist(), table["indices"], table["amounts"], strict=True
        )
    ]
    machine = FactorisationMachine.empty()
    machine.fit(rows)
    return machine


def score_quality(
    docs: DataFrame, machine: FactorisationMachine, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    NULL and empty texts are scored by their structure alone. Rows without
    doc_id are scored and not held out; repeated rows come back repeated; an
    empty table gives no rows; a missing or NULL ``n_chars`` is an input of its
    own; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.weights.astype(np.float32), machine.vectors.astype(np.float32))
    )

    def start():
        model = FactorisationMachine(*shared.value)

        def work(part):
            declared = part.column("n_chars").to_pylist()
            scores = [
                model.score(*features(text, n)) for text, n in zip(utf8(part), declared, strict=True)
            ]
            return [scores, [int(s >= threshold) for s in scores]]

        return work

    held_out = is_held_out(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out")
    return add_columns(_declared(docs), "score double, predicted int", start).select(
        "doc_id", held_out, "score", "predicted"
    )
