"""Removal of passages that an earlier document has, with a count-min prefilter.

A window is a run of words. First every partition of the documents makes a sparse
count-min sketch; the sketches are added, slice by slice, in a shuffle. A second
pass groups exactly only the windows that the sum estimates to be in two documents
or more. An estimate is never too low, so no repeated window is lost.

What is counted for a window is the least hash among its shorter grams: equal
windows have the same one, so its count, taken once per document, is at least that
of the window, and neighbouring windows mostly share it, which makes the sketch
several times smaller than one of all windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, mixed, rolling, slices, utf8, word_hashes

WINDOW = 13
GRAM = 7
DEPTH = 2
#: Bits of the broadcast filter per counted gram, and at most: 2 rows of 128 MiB.
BITS_PER_GRAM = 4
MOST_BITS = 1 << 30
_FINER = 3  # sketch cells are this many bits finer than the filter
_SLICE_ENTRIES = 1 << 20
_FLUSH = 1 << 21
_PLACES = ["high", "low", "doc_id", "version", "start", "more"]
_GRAM_FACTOR = 0x9E3779B97F4A7C15
_FACTORS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def least_grams(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each window of word hashes, the least hash of the grams within it."""
    grams = rolling(hashes, gram, _GRAM_FACTOR)
    count = len(hashes) - window + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    least = grams[:count].copy()
    for at in range(1, window - gram + 1):
        np.minimum(least, grams[at : at + count], out=least)
    return least


def _row_hash(values: np.ndarray, row: int) -> np.ndarray:
    """Independent hash of each sketch row."""
    return mixed(values + np.uint64((row + 1) * 0xD1B54A32D192ED03 % 2**64))


class Shape:
    """Sizes of sketch and filter for a number of grams; all powers of two."""

    def __init__(self, grams: float):
        wanted = max(1 << 16, BITS_PER_GRAM * grams)
        self.bits = min(MOST_BITS.bit_length() - 1, math.ceil(math.log2(wanted)))
        self.cell_bits = math.ceil(math.log2(wanted)) + _FINER  # grows with the input
        self.slice_bits = min(
            self.bits - 3, max(0, math.ceil(math.log2(max(1.0, grams / _SLICE_ENTRIES))))
        )


def partition_sketch(batches: Iterator, shape: Shape, window: int, gram: int):
    """Sparse sketches of a partition: for each row and slice the sorted cells as differences.

    Cells that two or more documents of the partition share are listed again,
    which is all of a count that matters here.
    """
    names = ["row", "slice", "wide", "first", "steps"]
    held, size = [], 0

    def emit():
        grams = np.concatenate([np.empty(0, np.uint64), *held])
        for row in range(DEPTH):
            cells = _row_hash(grams, row) >> np.uint64(64 - shape.cell_bits)
            cells, counts = np.unique(cells, return_counts=True)
            for listed in (cells, cells[counts > 1]):
                own = (listed >> np.uint64(shape.cell_bits - shape.slice_bits)).astype(np.int64)
                bounds = np.searchsorted(own, np.arange((1 << shape.slice_bits) + 1))
                columns = [[], [], [], [], []]
                for at in np.flatnonzero(np.diff(bounds)):
                    part = listed[bounds[at] : bounds[at + 1]]
                    steps = np.diff(part)
                    wide = bool(len(steps) and steps.max() >= 1 << 16)
                    blob = steps.astype(np.uint64 if wide else np.uint16).tobytes()
                    for column, value in zip(
                        columns, (row, int(at), wide, int(part[0]), blob), strict=True
                    ):
                        column.append(value)
                types = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    for part in slices(batches):
        for text in utf8(part):
            least = np.unique(least_grams(word_hashes(text.split()), window, gram))
            held.append(least)
            size += len(least)
        if size >= _FLUSH:
            yield from emit()
            held, size = [], 0
    yield from emit()


def _merge(shape: Shape):
    """Add the sketches of one row and slice; bits of the cells counted twice or more."""

    def merge(key, rows):
        cells = []
        for wide, first, steps in zip(rows["wide"], rows["first"], rows["steps"], strict=True):
            steps = np.frombuffer(steps, np.uint64 if wide else np.uint16).astype(np.uint64)
            cells.append(np.uint64(first) + np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)]))
        cells = np.sort(np.concatenate(cells))
        hot = cells[1:][cells[1:] == cells[:-1]] >> np.uint64(shape.cell_bits - shape.bits)
        bits = np.zeros(1 << (shape.bits - shape.slice_bits), bool)
        bits[(hot & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        row, at = (k.as_py() if hasattr(k, "as_py") else k for k in key)
        import pandas as pd

        return pd.DataFrame({"row": [row], "slice": [at], "bits": [np.packbits(bits).tobytes()]})

    return merge


class RepeatFilter:
    """Whether grams are estimated to be in two documents or more, by all rows of the sketch."""

    def __init__(self, shape: Shape, blocks: dict[tuple[int, int], bytes]):
        self.shape = shape
        size = 1 << max(0, shape.bits - shape.slice_bits - 3)
        empty = bytes(size)
        self.rows = [
            np.frombuffer(
                b"".join(blocks.get((row, at), empty) for at in range(1 << shape.slice_bits)),
                np.uint8,
            )
            for row in range(DEPTH)
        ]

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        found = np.ones(len(grams), bool)
        for row, bits in enumerate(self.rows):
            at = _row_hash(grams, row) >> np.uint64(64 - self.shape.bits)
            byte = bits[(at >> np.uint64(3)).astype(np.int64)]
            found &= (byte >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return found


def repeat_filter(texts: DataFrame, window: int, gram: int) -> RepeatFilter:
    """The merged sketch of all texts, as a filter of bounded size."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shape = Shape(size / 6 / 3.5)  # about six bytes a word; one gram in three to four is least
    merged = (
        texts.select("text")
        .mapInArrow(
            lambda batches: partition_sketch(batches, shape, window, gram),
            "row int, slice int, wide boolean, first bigint, steps binary",
        )
        .groupBy("row", "slice")
        .applyInPandas(_merge(shape), "row int, slice int, bits binary")
    )
    blocks = {(r["row"], r["slice"]): bytes(r["bits"]) for r in merged.toLocalIterator()}
    return RepeatFilter(shape, blocks)


def _places(window: int, held: list[tuple]):
    """What a chunk of documents, in ascending doc_id, says of its windows.

    Where a smaller doc_id of the chunk has the same window, a place is known to be
    repeated: such places of a text become one row of ``start`` -1, with their runs in
    ``more``. What is left is one row for each window and text of its least doc_id:
    the first start, and further ones in ``more``.
    """
    high, low, row, start = (np.concatenate(c) for c in list(zip(*held, strict=True))[2:])
    docs, versions = (np.array(c) for c in list(zip(*held, strict=True))[:2])
    order = np.argsort(high, kind="stable")  # rows and starts stay ascending within a window
    high, low, row, start = high[order], low[order], row[order], start[order]
    # Of two windows that share the first hash, places may alternate; they then count as
    # several windows, of which fewer are known here.
    fresh = np.ones(len(high), bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    heads = np.flatnonzero(fresh)
    least = docs[row[heads]][np.cumsum(fresh) - 1]
    known = docs[row] > least

    columns = [[] for _ in range(6)]

    def add(high, low, row, start, more):
        values = (high, low, docs[row], versions[row], start, more)
        for column, value in zip(columns, values, strict=True):
            column.append(value)

    at = np.flatnonzero(~known)
    first = np.ones(len(at), bool)
    first[1:] = fresh[at[1:]] | (row[at[1:]] != row[at[:-1]])
    heads = np.flatnonzero(first)
    more = np.full(len(heads), None, object)
    lengths = np.diff(np.append(heads, len(at)))
    for i in np.flatnonzero(lengths > 1):
        others = at[heads[i] + 1 : heads[i] + lengths[i]]
        more[i] = start[others].astype(np.int32).tobytes()
    opened = at[heads]
    by_text = np.argsort(order[opened])  # rows of one text follow each other: they compress well
    opened = opened[by_text]
    add(high[opened], low[opened], row[opened], start[opened], more[by_text])

    at = np.flatnonzero(known)
    if len(at):
        at = at[np.lexsort((start[at], row[at]))]
        row, start = row[at], start[at]
        edge = np.ones(len(at), bool)
        edge[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(edge)
        runs = np.empty((len(begin), 2), np.int32)
        runs[:, 0] = start[begin]
        runs[:, 1] = start[np.append(begin[1:], len(at)) - 1] + window
        owner = row[begin]
        bounds = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        texts = owner[bounds]
        blobs = np.empty(len(texts), object)
        blobs[:] = [part.tobytes() for part in np.split(runs, bounds[1:])]
        spread = mixed(docs[texts].view(np.uint64) + versions[texts].astype(np.uint64))
        none = np.full(len(texts), -1, start.dtype)
        add(spread, (spread >> np.uint64(32)).astype(np.uint32), texts, none, blobs)

    high, low, doc, version, start, more = (np.concatenate(c) for c in columns)
    arrays = [
        pa.array(high.view(np.int64)),
        pa.array(low.view(np.int32)),
        pa.array(doc),
        pa.array(version.astype(np.int32)),
        pa.array(start.astype(np.int32)),
        pa.array(more, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=_PLACES)


def repeated_windows(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, version, start, more``: places whose window also starts in a smaller doc_id.

    Rows of ``start`` -1 hold covered words as pairs of int32 (first, behind the last);
    other rows the first place of a window in a text, and further ones as int32.

    A chunk of some two million places decides by itself what it can, so a window comes
    to the shuffle once for each chunk and text of the chunk's least doc_id that has it,
    however many documents share it. Rows are sorted within their partition: chunks are
    the same when a lost executor's task is run again.
    """
    shared = texts.sparkSession.sparkContext.broadcast(repeat_filter(texts, window, gram))

    def estimated(batches):
        repeats = shared.value
        held, size, last = [], 0, None
        for part in slices(batches):
            for text, doc, version in zip(
                utf8(part),
                part.column("doc_id").to_pylist(),
                part.column("version").to_pylist(),
                strict=True,
            ):
                if (doc, version, text) == last:  # a repeated row is the same document
                    continue
                last = (doc, version, text)
                hashes = word_hashes(text.split())
                starts = np.flatnonzero(repeats(least_grams(hashes, window, gram)))
                if not len(starts):
                    continue
                high, low = (rolling(hashes, window, f)[starts] for f in _FACTORS)
                low = (low >> np.uint64(32)).astype(np.uint32)
                row = np.full(len(starts), len(held), np.int32)
                held.append((doc, version, high, low, row, starts.astype(np.int32)))
                size += len(starts)
                if size >= _FLUSH:
                    yield _places(window, held)
                    held, size = [], 0
        if held:
            yield _places(window, held)

    windows = texts.sortWithinPartitions("doc_id", "version", "text").mapInArrow(
        estimated, "high bigint, low int, doc_id bigint, version int, start int, more binary"
    )
    # One shuffle serves both the grouping and the join.
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # None is NULL, which both sides are told alike, so that they are the same shuffle.
    known = " AND ".join(f"{name} IS NOT NULL" for name in windows.columns if name != "more")
    windows = windows.where(known).repartition(partitions, "high", "low")
    is_open = F.col("start") >= 0
    used = F.when(F.col("version").isNotNull(), F.coalesce(F.length("more"), F.lit(0)))
    first = (
        windows.groupBy("high", "low")
        .agg(
            F.min(F.when(is_open, F.col("doc_id"))).alias("first"),
            F.max(F.when(is_open, F.col("doc_id"))).alias("last"),
            F.min("start").alias("least"),
            F.max(used).alias("p"),
        )
        # The last condition always holds. It keeps all columns needed on this side too;
        # else it would shuffle fewer columns, and so all rows a second time.
        .where("(first < last OR least < 0) AND p >= 0")
        .select("high", "low", "first")
    )
    return (
        windows.join(first, ["high", "low"])
        .where("start < 0 OR doc_id > first")
        .select("doc_id", "version", "start", "more")
    )


def _gone(count: int, window: int, starts, others, runs) -> np.ndarray:
    """Which of ``count`` words are covered, from the gathered places of a text."""
    edge = np.zeros(count + 1, np.int64)
    places = [np.asarray(starts, np.int32), *(np.frombuffer(o, np.int32) for o in others)]
    places = np.concatenate(places)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + window, -1)
    for blob in runs:
        pair = np.frombuffer(blob, np.int32).reshape(-1, 2)
        np.add.at(edge, pair[:, 0], 1)
        np.add.at(edge, pair[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row of ``docs``.

    Words covered by a window that also starts in a document of smaller doc_id are
    removed; windows are judged on the input. NULL and empty texts have no words.
    Rows without doc_id neither lose words nor cost others any. Rows that share a
    doc_id are one document: they do not shorten each other. Repeated rows come
    back repeated; an empty table gives no rows; other columns are ignored.
    ``doc_id`` must be a whole number, or text of one.
    """
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.hash("text").alias("version")
    )
    texts = keyed.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    is_open = F.col("start") >= 0
    removed = (
        repeated_windows(texts, window, gram)
        .groupBy("doc_id", "version")
        .agg(
            F.collect_set(F.when(is_open, F.col("start"))).alias("starts"),
            F.collect_set(F.when(is_open, F.col("more"))).alias("others"),
            F.collect_set(F.when(~is_open, F.col("more"))).alias("runs"),
        )
    )

    def start():
        def one(text, starts, others, runs):
            words = (text or b"").split()
            if not starts and not runs:
                return len(words), 0, b" ".join(words).decode()
            gone = _gone(len(words), window, starts, others, runs).tolist()
            kept = [word for word, out in zip(words, gone, strict=True) if not out]
            return len(words), len(words) - len(kept), b" ".join(kept).decode()

        def work(part):
            found = (part.column(name).to_pylist() for name in ("starts", "others", "runs"))
            rows = [one(*row) for row in zip(utf8(part), *found, strict=True)]
            return [[row[i] for row in rows] for i in range(3)]

        return work

    joined = keyed.join(removed, ["doc_id", "version"], "left").select(
        "doc_id", "text", "starts", "others", "runs"
    )
    fields = "n_words bigint, n_removed bigint, kept_text string"
    return add_columns(joined, fields, start).drop("text", "starts", "others", "runs")


def repeat_digest(docs: DataFrame) -> DataFrame:
    """``without_repeats`` with the SHA-256 of each kept text in its place."""
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
