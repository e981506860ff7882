"""Helpers of the text operators: streaming over texts, words, folds, bounded label samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_AT_ONCE = 256

Work = Callable[[pa.RecordBatch], Sequence]


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE):
    """Small pieces of Arrow batches, so that few texts exist as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(part: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """Texts as UTF-8 bytes."""
    return part.column(column).cast(pa.binary()).to_pylist()


def arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return simple[kind.simpleString()]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _names(fields: T.StructType) -> set[str]:
    return {f.name.lower() for f in fields}


def add_columns(df: DataFrame, fields: str, start: Callable[[], Work]) -> DataFrame:
    """Append computed columns, row by row in Python, without a shuffle.

    ``start`` runs once per task and returns the work for one piece of rows: it
    gives a list per field. As with ``withColumn``, an added column replaces one
    of the same name, but the work still sees the old one.
    """
    added = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name.lower() not in _names(added)]
    types = [arrow_type(f.dataType) for f in added]
    names = [f.name for f in kept] + [f.name for f in added]

    def run(batches):
        work = start()
        for part in slices(batches):
            old = [part.column(f.name) for f in kept]
            new = [pa.array(v, t) for v, t in zip(work(part), types, strict=True)]
            yield pa.RecordBatch.from_arrays(old + new, names=names)

    return df.mapInArrow(run, T.StructType(kept + added.fields))


def keep_rows(df: DataFrame, start: Callable[[], Work]) -> DataFrame:
    """Rows for which the work gives True; columns and their order stay."""

    def run(batches):
        work = start()
        for part in slices(batches):
            yield part.filter(pa.array(work(part), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word as uint64."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, length: int, factor: int) -> np.ndarray:
    """A 64-bit hash for each run of ``length`` hashes, as a polynomial with a mixed result."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for at in range(1, length):
        total *= np.uint64(factor)
        total += hashes[at : at + count]
    return mixed(total)


def mixed(value: np.ndarray) -> np.ndarray:
    """Finaliser of a multiplicative hash: every input bit reaches every output bit."""
    value = value ^ (value >> np.uint64(32))
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def remainder(key: Column, modulus: int) -> Column:
    """CRC-32 of the key as text, modulo ``modulus``; NULL without a key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def is_held_out(key: Column, modulus: int, rest: int) -> Column:
    return F.coalesce(remainder(key, modulus) == rest, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    held_out: int,
    most_rows: int,
    extra: Sequence[str] = (),
) -> DataFrame:
    """At most ``most_rows`` labelled documents outside the held-out fold: doc_id, text, target.

    The labels to use are the first in hash order of doc_id, so they do not
    depend on partitioning; that bound makes their broadcast safe. A document
    with contrary labels counts as 1; of documents sharing an id the least text
    is taken. NULL labels and NULL texts are left out.
    """
    key = F.col("doc_id")
    wanted = (
        labels.where(key.isNotNull() & F.col(label).isNotNull())
        .where(remainder(key, modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    return (
        docs.select("doc_id", "text", *extra)
        .where(F.col("text").isNotNull())
        .join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id", "target")
        .agg(F.min(F.struct("text", *extra)).alias("row"))
        .select("doc_id", "target", "row.*")
    )
