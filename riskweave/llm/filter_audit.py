"""Audit of how filters interact in every order, from sorted posting lists.

Every filter has, per part of the table and range of row ids, the sorted list of the
ids that fail it. Sizes of unions of these lists, for each set of filters, are all
that the counts of any order need: what a filter removes after others is the growth
of their union, and so on. A union is built by galloping: the ids of the shorter list
are searched in the longer one and only the new ones are put in. Ranges are
disjoint, so sizes add up over them, and a large part is many ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, utf8
from riskweave.operators.joins import measure, sized_join
from riskweave.sources.workspace import settle

FILTERS = "ABCDE"
RANGE_BITS = 14
MOST_FILTERS = 6  # 720 orders; more are refused
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))


def gallop_union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Sorted union of sorted lists without repeats, longest list first."""
    ordered = sorted(lists, key=len, reverse=True)
    union = ordered[0]
    for ids in ordered[1:]:
        if len(ids):
            missing = gallop_difference(ids, union)
            union = np.insert(union, np.searchsorted(union, missing), missing)
    return union


def gallop_difference(ids: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Those of the sorted ``ids`` that the sorted ``of`` lacks."""
    if not len(of):
        return ids
    at = np.searchsorted(of, ids)
    return ids[of[np.minimum(at, len(of) - 1)] != ids]


def union_sizes(lists: Sequence[np.ndarray]) -> list[int]:
    """Size of the union for each set of lists, a set being a bit mask; 0 for none.

    A set's union extends that of the set without its first list.
    """
    unions = [np.empty(0, np.int64)]
    for mask in range(1, 1 << len(lists)):
        first = (mask & -mask).bit_length() - 1
        unions.append(gallop_union([unions[mask & (mask - 1)], lists[first]]))
    return [len(u) for u in unions]


def posting_lists(
    rows: DataFrame, part: str, row_id: str, filters: Sequence[str], marks: Sequence[str]
) -> DataFrame:
    """``part, id_range, n, fails, marked``: sorted id lists per part and range of ids.

    ``filters`` and ``marks`` name boolean columns; NULL counts as false. ``row_id``
    must be stored and unique. A list has at most 2^14 ids.
    """
    ids = lambda c: F.sort_array(F.collect_list(F.when(F.col(c), F.col(row_id))))
    empty = F.array().cast("array<bigint>")
    listed = [F.coalesce(ids(c), empty) for c in [*filters, *marks]]
    found = rows.groupBy(
        F.col(part).alias("part"), F.shiftright(row_id, RANGE_BITS).alias("id_range")
    ).agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"_{i}") for i, c in enumerate(listed)])
    names = [F.col(f"_{i}") for i in range(len(listed))]
    return found.select(
        "part",
        "id_range",
        "n",
        F.array(*names[: len(filters)]).alias("fails"),
        (F.array(*names[len(filters) :]) if marks else F.array().cast("array<array<bigint>>")).alias("marked"),
    )


def _lists(column: pa.Array, row: int) -> list[np.ndarray]:
    return [np.asarray(ids.values, np.int64) for ids in column[row]]


def set_sizes(postings: DataFrame, filters: int, marks: int) -> DataFrame:
    """``part, n, sizes``: per part the union size of each set of filters.

    ``sizes`` has one block of 2^filters numbers for all rows and one for the rows
    of each mark. Every range is merged by itself and the sizes are added.
    """

    def run(batches):
        for batch in batches:
            fails, marked = batch.column("fails"), batch.column("marked")
            sizes = []
            for row in range(batch.num_rows):
                lists = _lists(fails, row)
                found = union_sizes(lists)
                for mark in _lists(marked, row):
                    unmarked = [gallop_difference(ids, mark) for ids in lists]
                    found += union_sizes(
                        [gallop_difference(ids, u) for ids, u in zip(lists, unmarked, strict=True)]
                    )
                sizes.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("n"), pa.array(sizes, pa.list_(pa.int64()))],
                names=["part", "n", "sizes"],
            )

    merged = postings.mapInArrow(run, "part string, n bigint, sizes array<bigint>")
    many = (1 + marks) << filters
    return (
        merged.groupBy("part")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("sizes")[i]).alias(f"_{i}") for i in range(many)])
        .select("part", "n", F.array(*[F.col(f"_{i}") for i in range(many)]).alias("sizes"))
    )


def _steps(filters: str) -> list[tuple]:
    """Every step of every order: place, order, step, masks before and after, filter, weights.

    The weights turn union sizes into what the filter removes over all orders: after
    each set of s other filters it stands in s! (k - 1 - s)! of them.
    """
    k = len(filters)
    weights = []
    for f in range(k):
        of = [0] * (1 << k)
        for mask in range(1 << k):
            if not mask >> f & 1:
                s = mask.bit_count()
                orders = factorial(s) * factorial(k - 1 - s)
                of[mask] -= orders
                of[mask | 1 << f] += orders
        weights.append(of)
    rows = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            name = "".join(filters[i] for i in order)
            rows.append((len(rows), name, step, before, after, 1 << f, weights[f]))
            before = after
    return rows


def audit_filters(
    rows: DataFrame,
    part: str,
    row_id: str,
    filters: dict[str, str],
    marks: dict[str, str],
) -> DataFrame:
    """Counts per part, order of the filters and step.

    ``filters`` maps one letter to the boolean column that is true where a row
    fails, ``marks`` an output name to the boolean column of the rows to count
    among the removed. ``row_id`` must be stored and unique. Columns: part,
    filter_order, step, kept, removed, redundant, unique_fails, shapley and one per
    mark. A table without rows has no parts.
    """
    letters = "".join(filters)
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters, not {len(filters)}")
    postings = posting_lists(rows, part, row_id, list(filters.values()), list(marks.values()))
    sizes = set_sizes(postings, len(filters), len(marks))
    steps = _steps(letters)
    table = rows.sparkSession.createDataFrame(
        steps,
        "place int, filter_order string, step int, before int, after int, own int, weights array<bigint>",
    )
    block = 1 << len(filters)
    every = F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("place")
    placed = sizes.select("*", every).join(F.broadcast(table), "place")

    def size(mask: Column, of: int = 0) -> Column:
        return F.get("sizes", mask + of * block)

    removed = size(F.col("after")) - size(F.col("before"))
    weighed = F.zip_with("weights", F.slice("sizes", 1, block), lambda w, u: w * u)
    everything = F.lit(block - 1)
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - size(F.col("after"))).alias("kept"),
        removed.alias("removed"),
        (size(F.col("own")) - removed).alias("redundant"),
        (size(everything) - size(everything - F.col("own"))).alias("unique_fails"),
        *[
            (size(F.col("after"), i) - size(F.col("before"), i)).alias(name)
            for i, name in enumerate(marks, 1)
        ],
        F.aggregate(weighed, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("shapley"),
    )


def fails(text: bytes | None) -> tuple[bytes, bool, bool, bool, bool]:
    """Digest of a text, and whether it fails A to D."""
    text = text or b""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))  # one byte per code point
    return (
        hashlib.md5(text, usedforsecurity=False).digest(),
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * upper > 5 * points,
        len(text.translate(None, _MARKS)) < len(text),
    )


def with_failures(docs: DataFrame) -> DataFrame:
    """``row, doc_id, part`` and ``fails_A`` to ``fails_E`` for each row of ``docs``.

    E needs one shuffle of digests for the least doc_id of each text; only texts
    found under several are joined back, by a join that minds size and skew.
    """

    def start():
        return lambda piece: list(zip(*map(fails, utf8(piece)), strict=True)) or [[]] * 5

    own = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    fields = "text binary, fails_A boolean, fails_B boolean, fails_C boolean, fails_D boolean"
    flagged = add_columns(own, fields, start)  # the text comes back as its digest
    rows = settle(flagged.withColumn("row", F.monotonically_increasing_id()))
    firsts = settle(
        rows.groupBy("text")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    joined = sized_join(rows, firsts, "text", "left", measure(firsts), salt_by=["row"])
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return joined.withColumn("fails_E", later).drop("text", "first")


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs``, per source.

    A NULL text is an empty one, a NULL source the part ''. A row without doc_id
    never fails E and has no labels; repeated rows count as often. A document is
    good or toxic if any of its labels says so. An empty table gives no rows; other
    columns are ignored.
    """
    rows = with_failures(docs)
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marked = settle(
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
        .where(F.col("good") | F.col("toxic"))
    )
    joined = sized_join(rows, marked, "doc_id", "left", measure(marked), salt_by=["row"])
    return audit_filters(
        joined,
        "part",
        "row",
        {f: f"fails_{f}" for f in FILTERS},
        {"good_lost": "good", "toxic_lost": "toxic"},
    )
