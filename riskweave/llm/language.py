"""Language proportions of a document by a mixture of n-gram models.

Each language has a smoothed distribution over hashed character trigrams. A
document is taken as a mixture of languages: expectation-maximisation estimates
their proportions from the likelihoods of its trigrams. Languages are added one
at a time, the one of steepest gain first, as long as the log-likelihood rises by
more than the penalty of another proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, is_held_out, remainder, slices

MODULUS, HELD_OUT = 3, 1
BUCKETS = 1 << 14
PER_LANGUAGE = 3000  # expected texts a language is learned from
SMOOTHING = 0.1  # added to every count
PENALTY = 3.0  # of another language, times the log of the number of trigrams
UNKNOWN = "und"
_CHUNK = 1 << 20


class Trigrams:
    """Counts of hashed trigrams over letters in lower case; other characters part words."""

    def __init__(self):
        self.letters = np.array([chr(c).isalpha() for c in range(0x10000)])

    def counts(self, text: str) -> np.ndarray | None:
        """Count per bucket, or None for a text without letters."""
        total, letters = np.zeros(BUCKETS, np.int64), False
        for at in range(0, len(text), _CHUNK):
            piece = f" {text[at : at + _CHUNK].lower()} ".encode("utf-32-le", "surrogatepass")
            codes = np.frombuffer(piece, np.uint32)
            is_letter = self.letters[np.minimum(codes, 0xFFFF)]
            for i in np.flatnonzero(codes > 0xFFFF):
                is_letter[i] = chr(codes[i]).isalpha()
            letters |= bool(is_letter.any())
            codes = np.where(is_letter, codes, np.uint32(32))
            value = codes[:-2] * np.uint32(0x9E3779B1)
            value = (value ^ codes[1:-1]) * np.uint32(0x85EBCA6B)
            value = (value ^ codes[2:]) * np.uint32(0xC2B2AE35)
            value ^= value >> np.uint32(16)
            # a trigram counts where its middle is a letter
            value = value[is_letter[1:-1]] & np.uint32(BUCKETS - 1)
            total += np.bincount(value, minlength=BUCKETS)
        return total if letters else None


@dataclass
class Shares:
    """Share of each bucket in each language, stored only where a language has the bucket.

    ``base`` is the share of a bucket that a language lacks. The entries of bucket b are
    ``starts[b]`` to ``starts[b + 1]``: a language and what its share is over its base. So
    the size follows from what the languages hold, however many there are.
    """

    base: np.ndarray
    starts: np.ndarray
    languages: np.ndarray
    extra: np.ndarray

    @classmethod
    def from_counts(cls, buckets: np.ndarray, languages: np.ndarray, counts: np.ndarray, many: int) -> Shares:
        """From one entry per bucket and language that has it."""
        totals = np.bincount(languages, counts, many) + SMOOTHING * BUCKETS
        order = np.lexsort((languages, buckets))
        starts = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
        of = languages[order].astype(np.int32)
        return cls(SMOOTHING / totals, starts, of, counts[order] / totals[of])

    @classmethod
    def from_table(cls, table: np.ndarray) -> Shares:
        """From one row per bucket and one column per language."""
        rows, columns = np.nonzero(table)
        starts = np.searchsorted(rows, np.arange(len(table) + 1))
        return cls(np.zeros(table.shape[1]), starts, columns.astype(np.int32), table[rows, columns])

    def entries(self, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row among ``buckets``, language and extra share of all their entries."""
        first, many = self.starts[buckets], self.starts[buckets + 1] - self.starts[buckets]
        rows = np.repeat(np.arange(len(buckets)), many)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many) + first[rows]
        return rows, self.languages[at], self.extra[at]


@dataclass
class LanguageModel:
    names: list[str]
    shares: Shares


def _mixture(counts: np.ndarray, shares: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation and the log-likelihood they reach."""
    total, weights = counts.sum(), start
    mixed = shares @ weights
    for _ in range(40):
        new = weights * ((counts / mixed) @ shares) / total
        mixed = shares @ new
        done = np.abs(new - weights).max() < 1e-4
        weights = new
        if done:
            break
    return weights, float(counts @ np.log(mixed))


def proportions(
    counts: np.ndarray, shares: Shares | np.ndarray, penalty: float = PENALTY
) -> dict[int, float]:
    """Number and proportion of each language that the penalised likelihood selects.

    Only the chosen languages have their shares spelled out, as columns.
    """
    if isinstance(shares, np.ndarray):
        shares = Shares.from_table(shares)
    seen = np.flatnonzero(counts)
    counts, base, many = counts[seen].astype(float), shares.base, len(shares.base)
    rows, of, extra = shares.entries(seen)
    total = counts.sum()

    def column(language: int) -> np.ndarray:
        own = np.full(len(seen), base[language])
        mine = of == language
        own[rows[mine]] += extra[mine]
        return own

    # log of a share is that of the base, and more where the language has the bucket
    with np.errstate(divide="ignore"):
        lacking = np.log(base)
        gain = np.log(base[of] + extra) - np.where(base[of] > 0, lacking[of], 0.0)
    covered = np.bincount(of, counts[rows], many)
    left = np.where(base > 0, total, total - covered)
    alone = np.bincount(of, counts[rows] * gain, many) + left * np.where(left > 0, lacking, 0.0)
    chosen = [int(alone.argmax())]
    columns = column(chosen[0])[:, None]
    weights, reached = np.ones(1), float(alone.max())
    cost = penalty * np.log(max(2.0, total))
    while len(chosen) < many:
        pull = counts / (columns @ weights)
        slope = base * pull.sum() + np.bincount(of, pull[rows] * extra, many) - total
        slope[chosen] = -np.inf
        more = int(slope.argmax())
        if slope[more] <= cost:  # bounds the gain of any mixture with it: the likelihood is concave
            break
        start = np.append(0.9 * weights, 0.1)
        wider = np.column_stack([columns, column(more)])
        new, value = _mixture(counts, wider, start)
        if value - reached <= cost:
            break
        columns = wider
        chosen, weights, reached = [*chosen, more], new, value
    return dict(zip(chosen, weights.tolist(), strict=True))


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Trigram models of all languages, from texts outside the held-out fold.

    Each learns from a hash sample of about ``per_language`` texts, or all it has. The
    model grows with the languages, not with the texts.
    """
    known = docs.where(
        F.col("lang").isNotNull() & (remainder(F.col("doc_id"), MODULUS) != HELD_OUT)
    )
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    grain = 1_000_000
    rated = sizes.select("lang", F.least(F.lit(1.0), per_language / F.col("n")).alias("rate"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(grain))
    sample = (
        known.select("doc_id", "text", "lang")
        .where(F.col("text").isNotNull())
        .join(F.broadcast(rated), "lang")
        .where(draw < F.col("rate") * grain)
    )

    def count(batches):
        trigrams, sums = Trigrams(), {}
        for part in slices(batches):
            for text, lang in zip(
                part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True
            ):
                own = trigrams.counts(text)
                if own is not None:
                    sums[lang] = sums.get(lang, 0) + own
        for lang, own in sums.items():
            seen = np.flatnonzero(own)
            columns = [pa.array([lang] * len(seen)), pa.array(seen), pa.array(own[seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    rows = (
        sample.select("text", "lang")
        .mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    coded = rows["lang"].combine_chunks().dictionary_encode()
    names = sorted(coded.dictionary.to_pylist())
    place = np.searchsorted(names, coded.dictionary.to_pylist()) if names else np.empty(0, np.int64)
    languages = place[coded.indices.to_numpy()]
    shares = Shares.from_counts(
        rows["bucket"].to_numpy(), languages, rows["n"].to_numpy().astype(float), len(names)
    )
    return LanguageModel(names, shares)


def predict_languages(
    docs: DataFrame, model: LanguageModel, penalty: float = PENALTY
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, mixture`` for each row of ``docs``.

    ``score`` is the proportion of the main language and ``mixture`` lists all
    selected ones as ``name:proportion``, largest first. NULL and empty texts
    and texts without a letter are ``und`` with score 0, as is everything where
    no language was learned. Equal proportions go to the earlier name. Rows
    without doc_id are not held out; repeated rows come back repeated; an empty
    table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.shares))

    def start():
        (names, shares), trigrams = shared.value, Trigrams()

        def one(text):
            counts = trigrams.counts(text) if text and names else None
            if counts is None:
                return UNKNOWN, 0.0, ""
            found = proportions(counts, shares, penalty)
            order = sorted(found, key=lambda i: (-found[i], names[i]))
            listed = ",".join(f"{names[i]}:{found[i]:.3f}" for i in order)
            return names[order[0]], min(1.0, max(0.0, found[order[0]])), listed

        def work(part):
            rows = [one(text) for text in part.column("text").to_pylist()]
            return [[row[i] for row in rows] for i in range(3)]

        return work

    held_out = is_held_out(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out")
    fields = "lang_pred string, score double, mixture string"
    scored = add_columns(docs.select("doc_id", "text"), fields, start)
    return scored.select("doc_id", held_out, "lang_pred", "score", "mixture")
