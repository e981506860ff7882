"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Each document's tokens are cut into full sequences and a rest, the rest into short
pieces. The pieces of many documents are shared out over windows: every piece starts
as a partial partition with one filled window; the two partial partitions of the
largest imbalance are merged, the fullest windows of one with the emptiest of the
other, until one is left. Its windows are nearly equal. If one exceeds the capacity,
the number of windows rises by one and all is done anew.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.text import slices

CAPACITY = 1024
PIECE = 256
WINDOWS_AT_ONCE = 128  # windows that are filled together; bounds memory and time
END_OF_TEXT = 0
LONG_RUN = 1 << 16  # whitespace characters; the pattern's engine fails at about a million
ADDED = {"<|endoftext|>": 50256}  # tokens of byte_bpe_50k.json that its ranks do not list


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Share out the items of these sizes over ``windows`` lists of nearly equal sums."""
    order = count()
    heap = []
    for item, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        members = [[item]] + [[] for _ in range(windows - 1)]
        heap.append((-size, next(order), sums, members))  # sums in falling order
    if not heap:
        return [[] for _ in range(windows)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        falling = np.argsort(-sums, kind="stable")
        joined = [x + y if y else x for x, y in zip(in_a, reversed(in_b), strict=True)]
        sums = sums[falling]
        members = [joined[i] for i in falling.tolist()]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), next(order), sums, members))
    return heap[0][3]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Items per window, no window over the capacity; each size must be within it."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while total:
        shared = differencing(sizes, windows)
        if max(sum(sizes[i] for i in window) for window in shared) <= capacity:
            return [window for window in shared if window]
        windows += 1
    return []


# What \s means to the pattern's engine: White_Space of Unicode, which is not Python's.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Encoder:
    """Byte-pair ids of whole texts, in which added tokens count wherever they stand.

    ``pattern`` must take runs of whitespace as ``\\s+(?!\\S)|\\s+`` does, after words
    with at most one space before them: all of a run is one part at the end of a text
    or before an added token, else all but its last character. Long runs are cut there
    and merged without the pattern.
    """

    def __init__(
        self,
        ranks: bytes,
        pattern: str,
        added: dict[str, int] = ADDED,
        long_run: int = LONG_RUN,
    ):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.model = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=table, special_tokens=added
        )
        ends = "|".join([r"\Z", *map(re.escape, added)])
        self.long = re.compile(f"[{_SPACE}]{{{long_run},}}+")
        self.last = re.compile(ends)

    def _found(self, text: str) -> list[int]:
        found, done = [], 0
        for run in self.long.finditer(text):
            end = run.end() if self.last.match(text, run.end()) else run.end() - 1
            found += self.model.encode(text[done : run.start()], allowed_special="all")
            found += self.model._encode_single_piece(text[run.start() : end])
            done = end
        return found + self.model.encode(text[done:] if done else text, allowed_special="all")

    def ids(self, text: str) -> np.ndarray:
        """Ids of ``text`` and the one that ends a document."""
        found = self._found(text)
        found.append(END_OF_TEXT)
        return np.array(found, "<u4")


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """One encoder per worker process, which outlives a task."""
    key = (zlib.crc32(ranks), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


def _sequences(batches: Iterator, encoder: Encoder, capacity: int, piece: int):
    """Rows of one partition: doc_id, start, ids, doc_tokens, sequence, offset."""
    sequence = count()
    held, tokens = [], 0

    def share_out():
        for window in pack([len(p[2]) for p in held], capacity):
            number, offset = next(sequence), 0
            for i in sorted(window):
                yield *held[i], number, offset
                offset += len(held[i][2])

    for part in slices(batches):
        rows = []
        for doc, text in zip(
            part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True
        ):
            ids = encoder.ids(text or "")
            full = len(ids) - len(ids) % capacity
            for at in range(0, full, capacity):
                rows.append((doc, at, ids[at : at + capacity], len(ids), next(sequence), 0))
            for at in range(full, len(ids), piece):
                held.append((doc, at, ids[at : at + piece], len(ids)))
            tokens += len(ids) - full
            if tokens >= capacity * WINDOWS_AT_ONCE:
                rows.extend(share_out())
                held, tokens = [], 0
        yield rows
    yield list(share_out())


def packed_pieces(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    if asked for, the ids. ``ranks_path`` names a vocabulary of byte-pair ranks; the
    driver reads it and sends its content to the executors, so it must be a
    tokenizer's file of a few megabytes. Packing happens within each input
    partition, without a shuffle, so one sequence per partition may be short.

    NULL and empty texts give one piece with the end id alone. Rows without doc_id
    and repeated rows are packed like any other; an empty table gives no rows; other
    columns are ignored.
    """
    with open(ranks_path, "rb") as file:
        content = file.read()
    if len(content) > 64 << 20:
        raise ValueError("a vocabulary of over 64 MiB is not sent to executors")
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        encoder = _encoder(shared.value, pattern)
        base = TaskContext.get().partitionId() << 40
        for rows in _sequences(batches, encoder, capacity, piece):
            ids = [row[2] for row in rows]
            values = {
                "doc_id": [row[0] for row in rows],
                "start": [row[1] for row in rows],
                "length": [len(x) for x in ids],
                "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids],
                "doc_tokens": [row[3] for row in rows],
                "sequence_id": [base + row[4] for row in rows],
                "offset": [row[5] for row in rows],
            }
            arrays = [pa.array(v, pa.int64()) for v in values.values()]
            if with_ids:
                values["ids"] = None
                arrays.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=list(values))

    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    ) + (", ids array<int>" if with_ids else "")
    if kind != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return docs.select("doc_id", "text").mapInArrow(run, schema)
