"""Table rows as input messages, for load tests and demonstrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import messages as M
from riskweave.functions.hashing import seeded_hash


def to_messages(transactions: DataFrame, ts: Column | None = None) -> DataFrame:
    """``key, value`` messages of all rows; every column but the label goes in."""
    columns = [c for c in transactions.columns if c != S.LABEL]
    card = F.col(S.CARD)
    return transactions.select(
        M.message_key(card).alias("key"), M.input_envelope(columns, card, ts).alias("value")
    )


_COARSE = 16  # bits: 65,536 counts reach the driver


def _crossing(hashes: DataFrame, part: Column, wanted: int) -> tuple[int, int] | None:
    """Part in which the ``wanted``-th row lies, and the rows before it."""
    before = 0
    counts = hashes.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    for row in counts.orderBy("part").collect():
        if before + row["n"] >= wanted:
            return row["part"], before
        before += row["n"]
    return None


def pick_rows(transactions: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` repeatably random rows: those with the least hash of their identifier.

    The n-th least hash is found from counts, so that all rows below it come from a
    filter over all partitions; only rows that share exactly that hash are put in
    order to fill up the number.
    """
    hashed = seeded_hash(seed, F.col(S.TRANSACTION_ID))
    hashes = transactions.select(hashed.alias("h"))
    if n <= 0:
        return transactions.limit(0)
    coarse = _crossing(hashes, F.shiftright("h", _COARSE), n)
    if coarse is None:
        return transactions
    within = hashes.where(F.shiftright("h", _COARSE) == coarse[0])
    value, before = _crossing(within, F.col("h"), n - coarse[1])
    rest = n - coarse[1] - before
    ties = transactions.where(hashed == value).orderBy(S.TRANSACTION_ID).limit(rest)
    return transactions.where(hashed < value).unionByName(ties)


def replay(transactions: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    return to_messages(pick_rows(transactions, n, seed))
