"""Training and validation splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions.hashing import in_fraction
from riskweave.operators.joins import DEFAULT_BOUND, BroadcastBound, exclude_keys


def training_rows(data: DataFrame, cutoff: int = S.TRAIN_SECONDS) -> DataFrame:
    return data.where(F.col(S.TIME) < cutoff)


def compromised_cards(train: DataFrame) -> DataFrame:
    """Distinct cards with a fraud in ``train``."""
    frauds = train.where((F.col(S.LABEL) == 1) & F.col(S.CARD).isNotNull())
    return frauds.select(S.CARD).distinct()


def train_validation_split(
    data: DataFrame,
    cutoff: int = S.TRAIN_SECONDS,
    bound: BroadcastBound = DEFAULT_BOUND,
) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cutoff`` and later rows of cards not yet compromised by then.

    A later row without a card is kept only if no card was compromised.
    """
    train = training_rows(data, cutoff)
    later = data.where(F.col(S.TIME) >= cutoff)
    salt_by = [S.TRANSACTION_ID] if S.TRANSACTION_ID in data.columns else None
    valid = exclude_keys(
        later, compromised_cards(train), S.CARD, "not_in", bound, salt_by=salt_by
    )
    return train, valid


def without_denied(
    data: DataFrame,
    denied: DataFrame,
    on: str = "device_id",
    bound: BroadcastBound = DEFAULT_BOUND,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key is not on a deny list; rows without a key are kept."""
    return exclude_keys(data, denied, on, "keep", bound, salt_by)


def hash_parts(
    data: DataFrame, fraction: float = 0.8, seed: int = 42, key: str = S.TRANSACTION_ID
) -> DataFrame:
    """All rows with ``in_first``: a repeatable draw, one hash and one scan for both parts."""
    return data.withColumn("in_first", in_fraction(seed, F.col(key), fraction))


def hash_split(
    data: DataFrame, fraction: float = 0.8, seed: int = 42, key: str = S.TRANSACTION_ID
) -> tuple[DataFrame, DataFrame]:
    """Random but repeatable split, independent of partitioning."""
    chosen = in_fraction(seed, F.col(key), fraction)
    return data.where(chosen), data.where(~chosen)


def hash_sample(
    data: DataFrame,
    fraction: float,
    seed: int = 42,
    key: str = S.TRANSACTION_ID,
    grain: int = 1_000_000,
) -> DataFrame:
    """Repeatable sample of about ``fraction`` of the keys."""
    return data.where(in_fraction(seed, F.col(key), fraction, grain))


def random_sample(data: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Spark's Bernoulli sample; its rows depend on the partitioning."""
    return data.sample(fraction, seed)
