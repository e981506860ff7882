"""Incremental conversion of arriving CSV files to Parquet."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave.schema import SENSOR_SCHEMA
from riskweave.sources.commits import commit_batch
from riskweave.sources.tables import (
    checked_path,
    csv_options,
    malformed,
    well_formed,
    with_record,
)


def start_csv_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = SENSOR_SCHEMA,
    pattern: str = "*.csv",
    interval: str | None = None,
    archive: str | None = None,
    delete_source: bool = False,
    max_files: int = 1000,
    rejects: str | None = None,
) -> StreamingQuery:
    """Convert each file that matches ``pattern`` once; the checkpoint remembers them.

    Batches are committed to ``target`` with a manifest each (``sources.commits``):
    ``read_committed`` sees whole batches only, and each once. A header that differs
    from the schema is an error. Malformed lines are committed to ``rejects`` in the
    same way; without it they are an error too.

    Without ``interval`` the query converts what is there and stops; with it
    the query keeps waiting for files. Cleaning the source (``archive`` or
    ``delete_source``) is best effort and may lag: nothing depends on it.
    """
    if archive and delete_source:
        raise ValueError("choose archive or delete_source, not both")
    reader = (
        spark.readStream.schema(with_record(schema))
        .options(**csv_options())
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", checked_path(archive)
        )
    elif delete_source:
        reader = reader.option("cleanSource", "delete")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    write_rows = commit_batch(checked_path(target))
    write_rejects = commit_batch(checked_path(rejects)) if rejects else None

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = malformed(lines)
            if not bad.isEmpty():
                if write_rejects is None:
                    raise ValueError("malformed lines, and no folder for rejects")
                write_rejects(bad, batch_id)
            write_rows(well_formed(lines), batch_id)
        finally:
            lines.unpersist()

    return (
        reader.csv(checked_path(source))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checked_path(checkpoint))
        .trigger(**trigger)
        .start()
    )
