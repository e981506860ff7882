"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their keys. The permutation works on a grid of
a x b cells with at least as many cells as rows: each round adds a hash of one
coordinate to the other. A number outside the table is permuted again until it
falls inside (cycle walking), so the result is a permutation of the row numbers.
Shard and slot of any row number follow from arithmetic alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.text import fresh, quoted
from riskweave.sources.workspace import settle

ROUNDS = 6
WALK = 64


def _hash(value: Column, seed: int, step: int) -> Column:
    return F.xxhash64(value, F.lit(seed * ROUNDS + step))


def _permute(number: Column, a: int, b: int, seed: int) -> Column:
    """One pass over the grid, as a struct that each round renews."""

    def round_of(step: int):
        def add(state: Column) -> Column:
            x, y = state["x"], state["y"]
            if step % 2:
                y = F.pmod(y + F.pmod(_hash(x, seed, step), F.lit(b)), F.lit(b))
            else:
                x = F.pmod(x + F.pmod(_hash(y, seed, step), F.lit(a)), F.lit(a))
            return F.struct(x.alias("x"), y.alias("y"))

        return add

    state = F.struct((number % a).alias("x"), F.floor(number / F.lit(a)).alias("y"))
    for step in range(ROUNDS):
        state = F.transform(F.array(state), round_of(step))[0]
    return F.transform(F.array(state), lambda s: s["x"] + s["y"] * a)[0]


def permuted(number: Column, rows: int, seed: int = 1) -> Column:
    """Place of row ``number`` (0-based) in a shuffle of ``rows`` rows.

    Fewer than one in sqrt(rows) numbers needs a second pass. A walk longer than
    ``WALK`` passes, with tables over 4096 rows less likely than 64**-64, is an
    error rather than a wrong place; smaller tables cannot have one.
    """
    a = max(1, math.isqrt(max(0, rows - 1)) + 1)
    b = max(1, -(-rows // a))
    first = _permute(number, a, b, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda at, _: F.when(at < rows, at).otherwise(_permute(at, a, b, seed)),
    )
    checked = F.when(walked < rows, walked).otherwise(
        F.raise_error(F.lit("cycle walking did not end")).cast("bigint")
    )
    return F.transform(
        F.array(first), lambda at: F.when(at < rows, at).otherwise(checked)
    )[0].cast("bigint")


def numbered(df: DataFrame, order_by: Sequence[Column], name: str) -> tuple[DataFrame, int]:
    """Rows with their 0-based number in a global order, and their count.

    A distributed sort is settled together with each row's place in its
    partition; the counts of earlier partitions, one row for each, are added.
    Of rows equal in the order, each gets a number of its own.
    """
    at, tie, part = (fresh(df, n) for n in ("_at", "_tie", "_part"))
    ordered = settle(
        df.withColumn(tie, F.monotonically_increasing_id())
        .orderBy(*order_by, tie)
        .drop(tie)
        .withColumn(at, F.monotonically_increasing_id())
    ).withColumn(part, F.shiftright(at, 33).cast("int"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = settle(ordered.groupBy(part).agg(F.count(F.lit(1)).alias("n")))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    shifts = counts.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    shift = fresh(ordered, "_shift")
    joined = ordered.join(F.broadcast(shifts.withColumnRenamed("n", shift)), part)
    result = joined.withColumn(name, F.col(shift) + place)
    return result.select(*[quoted(c) for c in df.columns], name), rows


def shard_rows(
    docs: DataFrame, order_by: Sequence[str | Column], shards: int = 24, seed: int = 1
) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) to all rows.

    Shard sizes differ by one row at most. NULL keys come first in the order;
    repeated rows get slots of their own; an empty table gives no rows. Columns
    named shard or slot are replaced.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order_by]
    number = fresh(docs, "_number")
    rows_numbered, rows = numbered(docs, columns, number)
    place = fresh(docs, "_place")
    placed = rows_numbered.withColumn(place, permuted(F.col(number), rows, seed))
    return placed.withColumns(
        {
            "shard": F.pmod(F.col(place), F.lit(shards)).cast("int"),
            "slot": F.floor(F.col(place) / F.lit(shards)).cast("bigint"),
        }
    ).drop(number, place)


def write_shards(sharded: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write each shard as a folder ``shard=<n>``, its rows in the order of their slots."""
    many = partitions or int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.floor(F.col("slot") / 100_000)
    (
        sharded.repartition(many, "shard", block)
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def shard_digest(docs: DataFrame, shards: int = 24, seed: int = 1) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs``.

    Rows are numbered by doc_id, then size and checksum of the text. The law is
    ``rows``: counts at most one apart. A NULL text counts as an empty one;
    columns other than doc_id and text do not matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(settle(digest), ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
