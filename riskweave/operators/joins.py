"""Joins against derived key sets and dictionaries, safe for any size and skew.

The derived side is measured first. While it is proven small it is broadcast,
so the big side is not shuffled at all. Beyond the bound both sides are shuffled
on (key, salt). A key of the big side with more rows than a task should have is hot:
its rows spread over as many salts as that takes, and the derived side repeats
just those keys, once per salt. There are at most (rows / rows per task) hot keys;
their list is broadcast, and rows per task grow until it is within the bound.

An anti join with a large key set first asks a Bloom filter of the keys. A row whose
key is surely absent stays without being shuffled; only the others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources.workspace import settle

_SALT = "_salt"
_SALTS = "_salts"
ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class BroadcastBound:
    """Largest side worth sending to every executor."""

    rows: int = 1_000_000
    bytes: int = 64 << 20


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def within(self, bound: BroadcastBound) -> bool:
        return self.rows <= bound.rows and self.bytes <= bound.bytes


DEFAULT_BOUND = BroadcastBound()


def measure(df: DataFrame) -> Size:
    """Row count and approximate bytes: 16 per row, plus 8 or the text length per column."""
    width = F.lit(16)
    for field in df.schema.fields:
        is_text = isinstance(field.dataType, (T.StringType, T.BinaryType))
        width = width + (
            F.coalesce(F.octet_length(field.name), F.lit(0)) + 8 if is_text else F.lit(8)
        )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def hot_keys(
    big: DataFrame,
    on: str,
    rows_per_task: int = ROWS_PER_TASK,
    bound: BroadcastBound = DEFAULT_BOUND,
) -> DataFrame:
    """Keys of ``big`` with more than ``rows_per_task`` rows, and how many salts they need.

    Counted map-side first. Should the list be over the bound, tasks get more rows.
    """
    counts = big.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    counts = settle(counts.where(F.col("n") > rows_per_task))
    while True:
        salts = F.ceil(F.col("n") / rows_per_task).cast("int").alias(_SALTS)
        hot = counts.where(F.col("n") > rows_per_task).select(on, salts)
        if measure(hot).within(bound):
            return hot
        rows_per_task *= 2


_WORD, _BITS = "_word", "_bits"
_BITS_PER_KEY = 4
_WORDS_PER_KEY = 0.25  # 16 bits a key: about one absent key in a hundred is not told apart
MOST_WORDS = 1 << 20  # of 64 bits; with more keys than fit, more rows are joined
_EXACT_HASH = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType, T.BinaryType)


def _word_and_bits(key: Column, words: int) -> tuple[Column, Column]:
    """The word of the filter a key belongs to, and the bits it sets there."""
    drawn = F.xxhash64(key, F.lit(1))
    bits = F.lit(0).cast("bigint")
    for i in range(_BITS_PER_KEY):
        place = F.shiftrightunsigned(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return F.pmod(F.xxhash64(key), F.lit(words)), bits


def key_filter(keys: DataFrame, on: str, words: int) -> DataFrame:
    """Bloom filter as rows ``_word, _bits``, at most ``words`` of them.

    Every key sets its bits in one 64-bit word. Words are combined by OR, in any order
    and before the shuffle, so filters of parts of the keys merge into that of all.
    """
    word, bits = _word_and_bits(F.col(on), words)
    return keys.select(word.alias(_WORD), bits.alias(_BITS)).groupBy(_WORD).agg(
        F.bit_or(_BITS).alias(_BITS)
    )


def split_by_filter(
    df: DataFrame, keys: DataFrame, on: str, size: Size, most_words: int = MOST_WORDS
) -> tuple[DataFrame, DataFrame] | None:
    """Rows whose key is surely not among ``keys``, NULL included, and all other rows.

    None if the key's type has equal values with unequal hashes, or differs from
    that of ``keys``. Neither part is shuffled.
    """
    kind = df.schema[on].dataType
    exact = isinstance(kind, _EXACT_HASH) or kind == T.StringType()
    if not exact or kind != keys.schema[on].dataType:
        return None
    words = min(most_words, max(1, 1 << math.ceil(math.log2(max(1, size.rows * _WORDS_PER_KEY)))))
    known = settle(key_filter(keys, on, words)).toDF(_WORD, "_known")
    word, bits = _word_and_bits(F.col(on), words)
    asked = df.withColumns({_WORD: word, _BITS: bits}).join(F.broadcast(known), _WORD, "left")
    found = F.col("_known").bitwiseAND(F.col(_BITS)) == F.col(_BITS)
    maybe = F.coalesce(found, F.lit(False)) & F.col(on).isNotNull()
    return asked.where(~maybe).select(df.columns), asked.where(maybe).select(df.columns)


def _salted_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str,
    salt_by: Sequence[str] | None,
    rows_per_task: int,
) -> DataFrame:
    """Rows are salted by ``salt_by``; without it they are numbered, and settled with
    their numbers: numbers drawn anew after a lost executor could change a row's salt.
    """
    if salt_by is None:
        big = settle(big.withColumn(_SALT, F.monotonically_increasing_id()))
    drawn = F.xxhash64(*(salt_by or [_SALT]))
    hot = F.broadcast(hot_keys(big, on, rows_per_task))
    numbered = big.withColumn(_SALT, drawn).join(hot, on, "left")
    nulls = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(F.col(on).isNull(), F.lit(nulls)).otherwise(F.coalesce(_SALTS, F.lit(1)))
    left = numbered.withColumn(_SALT, F.pmod(F.col(_SALT), spread).cast("int")).drop(_SALTS)
    every = F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)
    right = small.join(hot, on, "left").withColumn(_SALT, F.explode(every)).drop(_SALTS)
    return left.join(right, [on, _SALT], how).drop(_SALT)


def sized_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str,
    size: Size,
    bound: BroadcastBound = DEFAULT_BOUND,
    salt_by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``big`` with a ``small`` whose ``size`` was measured.

    ``how`` must keep rows of the big side only (inner, left, left_semi or
    left_anti); ``salt_by``, if given, should identify a row of it.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if size.within(bound):
        return big.join(F.broadcast(small), on, how)
    return _salted_join(big, small, on, how, salt_by, rows_per_task)


def exclude_keys(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    null_keys: str = "keep",
    bound: BroadcastBound = DEFAULT_BOUND,
    salt_by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``.

    ``null_keys="keep"`` is a plain anti join: a NULL key matches nothing and
    stays. ``null_keys="not_in"`` is SQL ``NOT IN`` over the non-NULL keys: a
    NULL key stays only if the set is empty.
    """
    if null_keys not in ("keep", "not_in"):
        raise ValueError(f"null_keys must be 'keep' or 'not_in', not {null_keys!r}")
    known = settle(keys.select(on).where(F.col(on).isNotNull()).distinct())
    size = measure(known)
    if size.rows == 0:
        return df
    if null_keys == "not_in":
        df = df.where(F.col(on).isNotNull())
    columns = df.columns
    parts = None if size.within(bound) else split_by_filter(df, known, on, size)
    sure, open_rows = parts or (None, df)
    kept = sized_join(open_rows, known, on, "left_anti", size, bound, salt_by, rows_per_task)
    kept = kept.select(columns)
    return kept if sure is None else sure.unionAll(kept)
