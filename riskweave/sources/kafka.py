"""Kafka source and sink. The connector package must be on the Spark class path.

Addresses and credentials come from the caller's options only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    options: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of ``key, value, topic, partition, offset, headers``; starts at the latest offsets.

    The query's checkpoint keeps the offsets, in place of a consumer group.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("includeHeaders", "true")
        .options(**dict(options or {}))
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def write_messages(
    messages: DataFrame,
    servers: str,
    topic: str,
    options: Mapping[str, str] | None = None,
) -> None:
    """Send the rows (``key, value``, maybe ``headers``) of a batch.

    At-least-once when Spark retries tasks: readers of results take repeats out by
    their origin (``streaming.publishing``).
    """
    (
        messages.select([c for c in ("key", "value", "headers") if c in messages.columns])
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**dict(options or {}))
        .save()
    )
