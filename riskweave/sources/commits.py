"""Committed batches: a batch counts once its manifest is there, and only then.

Each attempt at a batch writes a Parquet folder of its own,
``<table>/batch=<writer>-<id>-<attempt>``. Its manifest, ``<table>/_commits/<writer>-<id>.json``,
names the folder with its files and rows; it is put in place last, by a rename that
refuses to replace another one. Readers follow the manifests, so a torn attempt is
never seen, and a repeated batch finds its manifest and writes nothing. The writer
is the streaming query, known by the id its checkpoint holds: a new checkpoint
starts new batches rather than taking old ones for its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskweave.sources.tables import checked_path, exists

MANIFEST = (
    "writer string, batch bigint, folder string, rows bigint, "
    "files array<struct<name: string, bytes: bigint>>"
)
_LOG = "_commits"


def _hadoop(spark: SparkSession, path: str):
    """A path, its file system and its file context."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf)
    return at, at.getFileSystem(conf), context


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place, whole or not at all; an error if there is one already."""
    folder, name = path.rsplit("/", 1)
    draft, system, context = _hadoop(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    no_options = spark.sparkContext._gateway.new_array(kind, 0)
    context.rename(draft, spark._jvm.org.apache.hadoop.fs.Path(path), no_options)


def _drop_attempts(spark: SparkSession, table: str, stem: str) -> None:
    """Remove folders of earlier attempts at one batch that has no manifest."""
    pattern, system, _ = _hadoop(spark, f"{table}/{stem}-*")
    for status in system.globStatus(pattern) or []:
        system.delete(status.getPath(), True)


def _files(spark: SparkSession, folder: str) -> list[dict]:
    at, system, _ = _hadoop(spark, folder)
    listed = [(s.getPath().getName(), s.getLen()) for s in system.listStatus(at)]
    return [{"name": n, "bytes": b} for n, b in sorted(listed) if not n.startswith(("_", "."))]


def commit(rows: DataFrame, table: str, batch: int, writer: str = "once") -> bool:
    """Write one batch and its manifest; False if the batch was committed before."""
    spark, table = rows.sparkSession, checked_path(table).rstrip("/")
    manifest = f"{table}/{_LOG}/{writer}-{batch}.json"
    if exists(spark, manifest):
        return False
    stem = f"batch={writer}-{batch}"
    _drop_attempts(spark, table, stem)
    folder = f"{stem}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(f"{table}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{table}/{folder}").count()  # from footers
    entry = {
        "writer": writer,
        "batch": batch,
        "folder": folder,
        "rows": written,
        "files": _files(spark, f"{table}/{folder}"),
    }
    publish(spark, manifest, json.dumps(entry))
    return True


def commit_batch(table: str) -> Callable[[DataFrame, int], None]:
    """Writer for ``foreachBatch`` that commits each batch of its query once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        commit(batch, table, batch_id, query or "once")

    return write


def manifests(spark: SparkSession, table: str) -> DataFrame:
    """One row per committed batch."""
    log = f"{checked_path(table).rstrip('/')}/{_LOG}"
    if not exists(spark, log):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{log}/*.json")


def read_committed(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Rows of all committed batches, with the columns of ``schema`` only.

    Folders are read as they are, so their names add no column. The driver sees one
    name per batch. ``damaged_batches`` checks the folders against their manifests.
    """
    root = checked_path(table).rstrip("/")
    folders = [f"{root}/{r['folder']}" for r in manifests(spark, root).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders).select(*schema.names)


def damaged_batches(spark: SparkSession, table: str) -> list[str]:
    """Folders whose files are not those of their manifest."""
    root = checked_path(table).rstrip("/")
    wrong = []
    for row in manifests(spark, root).toLocalIterator():
        folder = f"{root}/{row['folder']}"
        found = _files(spark, folder) if exists(spark, folder) else None
        if found != [f.asDict() for f in row["files"]]:
            wrong.append(row["folder"])
    return sorted(wrong)
