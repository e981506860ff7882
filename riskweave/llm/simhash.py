"""Near duplicates by SimHash fingerprints, compared exactly tile by tile.

A tile holds fingerprints of equal population counts in each of some parts of their
64 bits. Flipping one bit changes one of these counts by one, so two fingerprints
within ``radius`` bits lie in tiles whose counts differ by at most ``radius`` in sum;
all other pairs of tiles are skipped. What is left is compared exactly by
exclusive-or and bit counts. Crowded tiles are cut into pieces, every pair of
which is compared.

More parts make smaller tiles with more neighbours: fewer comparisons, more copies.
The number of parts follows from that of the fingerprints; links do not depend on it.
"""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.components import connected_components
from riskweave.llm.text import add_columns, fresh, utf8
from riskweave.operators.joins import DEFAULT_BOUND, BroadcastBound, measure, sized_join
from riskweave.sources.workspace import settle

BITS = 64
PARTS = (4, 8, 12, 16)  # numbers of parts to choose from
TILE = 2048
# Nanoseconds, as measured, for a comparison, a shuffled fingerprint and a shuffled tile.
_COMPARE, _MOVE, _VISIT = 8.0, 80.0, 3000.0
_BLOCK = 1 << 16
_CELLS_AT_ONCE = 1 << 20


def fingerprint(text: bytes | None, length: int = 3) -> int:
    """SimHash of the word shingles of ``text``, as a signed 64-bit integer; no words give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < length:
        shingles = iter([b" ".join(words)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(length)), strict=False))
        count = len(words) - length + 1
    ones = np.zeros(64, np.int64)
    while block := list(itertools.islice(shingles, _BLOCK)):
        digests = map(xxhash.xxh64_intdigest, block, itertools.repeat(42))
        hashes = np.fromiter(digests, np.uint64, len(block))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, length: int = 3) -> DataFrame:
    """Add ``fingerprint`` to rows that have a ``text``."""

    def start():
        return lambda part: [[fingerprint(t, length) for t in utf8(part)]]

    return add_columns(docs, "fingerprint bigint", start)


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect the same nodes: each node with the least of its group."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, least):
            break
        least = new
    moved = least != np.arange(len(nodes))
    return nodes[moved], nodes[least[moved]]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges joining all of ``a`` and ``b`` within ``radius`` bits, at most one per node or few."""
    us, vs, held = [], [], 0
    step = max(1, _CELLS_AT_ONCE // max(1, len(b)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        u, v = a[at : at + step][i], b[j]
        other = u != v
        us.append(u[other])
        vs.append(v[other])
        held += int(other.sum())
        if held > len(a) + len(b):
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], 0
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *us]), np.concatenate([empty, *vs])


def part_sizes(parts: int) -> list[int]:
    """Bits of each part, as equal as they can be."""
    return [BITS * (i + 1) // parts - BITS * i // parts for i in range(parts)]


def _offsets(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within ``radius`` in sum; of each and its negative only one."""

    def within(parts, left):
        if parts == 0:
            return [()]
        steps = range(-left, left + 1)
        return [(d, *rest) for d in steps for rest in within(parts - 1, left - abs(d))]

    return [d for d in within(parts, radius) if d >= (0,) * parts]


def parts_for(distinct: int, radius: int = 3, tile: int = TILE) -> int:
    """The number of parts of least cost, were the bits of the fingerprints even draws."""

    def cost(parts):
        near = len(_offsets(parts, radius))
        mates = distinct * math.prod(math.comb(2 * s, s) / 4**s for s in part_sizes(parts))
        held, pieces = min(max(mates, 1.0), tile), max(1.0, mates / tile)
        return near * (_COMPARE * mates + pieces * (_MOVE + _VISIT / held))

    return min(PARTS, key=cost)


def _code(counts, sizes: list[int]):
    total = 0
    for count, size in zip(counts, sizes, strict=True):
        total = total * (size + 1) + count
    return total


def _neighbours(sizes: list[int], radius: int):
    """Column of the tiles to compare with, as far as all counts stay in their range."""
    offsets = [{"code": _code(d, sizes), "steps": d} for d in _offsets(len(sizes), radius)]
    # As one text, which the optimizer reads once; thousands of literals take it seconds.
    near = F.from_json(F.lit(json.dumps(offsets)), "array<struct<code: bigint, steps: array<int>>>")

    def fits(offset):
        inside = F.lit(True)
        for part, size in enumerate(sizes):
            inside &= (F.col(f"p{part}") + offset["steps"][part]).between(0, size)
        return inside

    return F.transform(F.filter(near, fits), lambda offset: F.col("cell") + offset["code"])


def links(
    fingerprints: DataFrame,
    radius: int = 3,
    tile: int = TILE,
    parts: int | None = None,
    bound: BroadcastBound = DEFAULT_BOUND,
) -> DataFrame:
    """Edges ``u, v`` that connect all of the distinct ``fingerprint`` within ``radius`` bits.

    Pairs within a dense group are not all listed: each comparison of two tiles
    gives at most as many edges as it has fingerprints.
    """
    sizes = part_sizes(parts or parts_for(fingerprints.count(), radius, tile))
    counts, at = {}, 0
    for i, size in enumerate(sizes):
        bits = F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << size) - 1))
        counts[f"p{i}"], at = F.bit_count(bits), at + size
    parted = fingerprints.select("fingerprint").withColumns(counts)
    places = [F.col(name).cast("bigint") for name in counts]
    parted = parted.withColumn("cell", _code(places, sizes))
    cells = settle(
        parted.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("pieces"))
    )
    # Tiles that nobody is in are not visited while the list of all is within the bound.
    # Beyond it only the crowded ones are looked up, which are at most one for each
    # ``tile`` fingerprints, and visits to empty tiles end there.
    size, how = measure(cells), "inner"
    if not size.within(bound):
        cells = settle(cells.where(F.col("pieces") > 1))
        size, how = measure(cells), "left"
    keys = ["cell", *counts]
    known = sized_join(parted, cells, "cell", how, size, bound, ["fingerprint"])
    piece = F.pmod(F.xxhash64("fingerprint"), F.coalesce("pieces", F.lit(1))).cast("int")
    tiles = settle(
        known.select("fingerprint", *keys, piece.alias("piece"))
        .groupBy(*keys, "piece")
        .agg(F.collect_list("fingerprint").alias("members"))
    )
    others = cells.select(F.col("cell").alias("other"), F.col("pieces").alias("others"))
    same_tile = F.col("cell") == F.col("other")
    target = ["other", "other_piece"]
    near = tiles.withColumn("other", F.explode(_neighbours(sizes, radius)))
    last = F.coalesce("others", F.lit(1)) - 1
    visits = (
        sized_join(near, others, "other", how, size, bound, ["cell", "piece", "other"])
        .withColumn("other_piece", F.explode(F.sequence(F.lit(0), last)))
        .where(~same_tile | (F.col("piece") <= F.col("other_piece")))
        .select(*target, F.lit(1).alias("visits"), "members")
    )
    homes = tiles.select(
        F.col("cell").alias("other"), F.col("piece").alias("other_piece"), F.lit(0), "members"
    )
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches):
        """A tile comes before its visitors; only it and one batch of these are in memory."""
        home, own = np.empty(0, np.uint64), None
        for batch in batches:
            us, vs = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            members = batch.column("members")
            ends = members.offsets.to_numpy()
            values = members.values.to_numpy().view(np.uint64)
            keys = np.stack([batch.column(c).to_numpy() for c in (*target, "visits")])
            runs = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *runs.tolist(), batch.num_rows] if batch.num_rows else []
            for i, j in zip(edges, edges[1:], strict=False):
                run = values[ends[i] : ends[j]]
                if keys[2, i] == 0:
                    home, own = run, tuple(keys[:2, i])
                    continue
                if own != tuple(keys[:2, i]):
                    continue  # nobody is there
                u, v = close_pairs(run, home, radius)
                us.append(u)
                vs.append(v)
            columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    return (
        homes.union(visits)
        .toDF(*target, "visits", "members")
        .repartition(partitions, *target)
        .sortWithinPartitions(*target, "visits")
        .mapInArrow(compare, "u bigint, v bigint")
    )


def groups(fingerprints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """``fingerprint, component`` of all distinct fingerprints; one of its members names a component."""
    distinct = settle(fingerprints.select("fingerprint").distinct())
    roots = connected_components(links(distinct, radius, tile))
    return distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("component")
    )


def near_duplicates(docs: DataFrame, length: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    The component is named by its least doc_id. A NULL or empty text has
    fingerprint zero and is linked like any other; a row without doc_id has a
    component, but never names it unless all its rows lack one (then NULL).
    Repeated rows come back as often as they came; columns other than doc_id and
    text do not matter; an empty table gives no rows.
    """
    prints = settle(with_fingerprints(docs.select("doc_id", "text"), length).drop("text"))
    member = settle(groups(prints, radius))
    firsts = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    least = (
        member.join(firsts, "fingerprint")
        .groupBy("component")
        .agg(F.min("first").alias("component_id"))
    )
    names = settle(member.join(least, "component").select("fingerprint", "component_id"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(names, "fingerprint").select("doc_id", digits, "component_id")


def one_of_each_group(docs: DataFrame, length: int = 3, radius: int = 3) -> DataFrame:
    """One row of each near-duplicate group, with all its columns.

    It is the row of the least doc_id (NULL last), then of the least text hash;
    of rows equal in both any one stays.
    """
    key, text_key = "doc_id", "_text_key"
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias(text_key))
    prints = settle(with_fingerprints(keyed, length).drop("text"))
    member = settle(groups(prints, radius))
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key), F.col(text_key))
    firsts = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    chosen = settle(
        member.join(firsts, "fingerprint")
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select(
            F.coalesce(F.col("first.doc_id"), F.lit(0)).alias("_id"),
            F.col("first.none").alias("_none"),
            F.col(f"first.{text_key}").alias("_text"),
        )
    )
    ids = [fresh(docs, name) for name in chosen.columns]
    values = [F.coalesce(F.col(key), F.lit(0)), F.col(key).isNull(), F.xxhash64("text")]
    marked = docs.withColumns(dict(zip(ids, values, strict=True)))
    chosen = chosen.toDF(*ids)
    return marked.join(chosen, ids, "left_semi").dropDuplicates(ids).select(docs.columns)
