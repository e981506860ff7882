"""Scoring of live messages with a fitted pipeline.

Works on any streaming (or batch) DataFrame with a ``value`` column.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskweave import schema as S
from riskweave.functions import messages as M
from riskweave.functions.expressions import positive_probability
from riskweave.streaming.publishing import ORIGIN, PLACE, origin_headers, place

BAD_ENVELOPE = "bad_envelope"
NO_FEATURES = "no_features"
BAD_FEATURES = "bad_features"
BAD_VALUE = "bad_value"
NO_ROW = "no_row"
SEVERAL_ROWS = "several_rows"
MISSING_ID = "missing_id"
RESULT_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)


def _evaluated_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters use as it is.

    A filter on a plain column would be pushed below the projection with the
    column's whole expression copied into it, once per use. It cannot pass a
    generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_messages(
    messages: DataFrame, schema: T.StructType = S.SCORING_SCHEMA
) -> DataFrame:
    """``value, ts, card_id, reject_reason`` and the columns of ``schema``.

    A message holds one row, under any key. A feature absent from it is NULL.
    ``reject_reason`` is NULL for usable rows; a value that is no number, or an
    integer with a fraction or too large for its type, makes the row unusable, and
    so do several rows, none, or a row without identifier. Messages that have
    ``topic, partition, offset`` get these as ``origin`` too.
    """
    envelope, features = F.col("_envelope"), F.col("_features")
    traced = set(PLACE) <= set(messages.columns)
    origin = [place(messages).alias(ORIGIN)] if traced else []
    parsed = messages.select(F.col("value").cast("string").alias("value"), *origin)
    parsed = _evaluated_once(parsed, "_envelope", M.parse_envelope(F.col("value")))
    parsed = _evaluated_once(
        parsed, "_features", M.parse_features(envelope["features"], schema)
    )
    parsed = _evaluated_once(parsed, "_rows", M.row_count(features, schema))
    reason = (
        F.when(envelope.isNull() | envelope[M.CORRUPT].isNotNull(), BAD_ENVELOPE)
        .when(envelope["features"].isNull(), NO_FEATURES)
        .when(features.isNull() | features[M.CORRUPT].isNotNull(), BAD_FEATURES)
        .when(F.col("_rows") == 0, NO_ROW)
        .when(F.col("_rows") > 1, SEVERAL_ROWS)
        .when(M.misfit(features, schema), BAD_VALUE)
    )
    names = {f.name: f for f in schema.fields}
    if S.TRANSACTION_ID in names:
        identifier = M.feature_value(features, names[S.TRANSACTION_ID])
        reason = reason.when(identifier.isNull(), MISSING_ID)
    return parsed.select(
        "value",
        envelope["ts"].alias("ts"),
        envelope["card_id"].alias("card_id"),
        reason.alias("reject_reason"),
        *[M.feature_value(features, f).alias(f.name) for f in schema.fields],
        *([ORIGIN] if traced else []),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("value", "reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def without_usable_text(parsed: DataFrame) -> DataFrame:
    """Parsed messages without the text of those that are usable: nobody reads it again."""
    return parsed.withColumn("value", F.when(F.col("reject_reason").isNotNull(), F.col("value")))


def score_rows(transactions: DataFrame, model: PipelineModel) -> DataFrame:
    """``TransactionID, card1, probability_`` of each transaction, and ``origin`` if it has one."""
    return model.transform(transactions).select(
        S.TRANSACTION_ID,
        S.CARD,
        positive_probability(F.col("probability")).alias("probability_"),
        *([ORIGIN] if ORIGIN in transactions.columns else []),
    )


def result_messages(scored: DataFrame) -> DataFrame:
    """``key, value`` messages keyed by card; ``headers`` name the origin of rows that have one."""
    envelope = M.result_envelope(
        F.col(S.TRANSACTION_ID), F.col(S.CARD), F.col("probability_")
    )
    traced = ORIGIN in scored.columns
    return scored.select(
        M.message_key(F.col(S.CARD)).alias("key"),
        envelope.cast("binary").alias("value"),
        *([origin_headers(F.col(ORIGIN)).alias("headers")] if traced else []),
    )


def score_stream(messages: DataFrame, model: PipelineModel) -> tuple[DataFrame, DataFrame]:
    """Result messages, and the unusable messages with their reasons."""
    parsed = parse_messages(messages)
    return result_messages(score_rows(usable(parsed), model)), rejected(parsed)


BatchWriter = Callable[[DataFrame, int], None]


@dataclass
class Traffic:
    """Messages handled so far by a running query, as it reports them batch by batch.

    A repeated batch counts again, as far as its writers look at it; so do messages
    computed anew after the loss of an executor.
    """

    received: int = 0
    sent: int = 0
    rejected: int = 0
    _ended: threading.Event = field(default_factory=threading.Event, repr=False, compare=False)

    def final(self, timeout: float = 60.0) -> Traffic:
        """The counts once the query has ended and reported its last batch."""
        self._ended.wait(timeout)
        return self


class _TrafficListener(StreamingQueryListener):
    """Adds up one metric of the plan, as the batches report it."""

    def __init__(self, metric: str, traffic: Traffic):
        self._metric, self._traffic = metric, traffic
        self._run: str | None = None
        self._gone: set[str] = set()
        self._lock = threading.Lock()

    def follow(self, query: StreamingQuery) -> None:
        with self._lock:
            self._run = str(query.runId)
            self._settle()

    def _settle(self) -> None:
        if self._run in self._gone:
            self._traffic._ended.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self._metric)
        if seen is not None:
            self._traffic.received += seen["received"]
            self._traffic.rejected += seen["rejected"]
            self._traffic.sent += seen["received"] - seen["rejected"]

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._gone.add(str(event.runId))
            self._settle()


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    write_results: BatchWriter,
    write_rejects: BatchWriter,
    checkpoint: str,
    trigger: dict | None = None,
    traffic: Traffic | None = None,
) -> StreamingQuery:
    """Long-running scoring with a side output for unusable messages, if there are any.

    A writer gets a batch and its id. After a failure Spark repeats a batch
    under the same id, so a writer that replaces the output of that id makes
    the result exactly-once; plain appends are at-least-once, and
    ``publishing.first_of_each_origin`` takes their repeats out again.
    """

    parsed = parse_messages(messages)
    listener = None
    if traffic is not None:  # counted by the plan as it runs, without a job of its own
        metric = f"traffic_{uuid.uuid4().hex}"
        counts = F.count(F.lit(1)).alias("received"), F.count("reject_reason").alias("rejected")
        parsed = parsed.observe(metric, *counts)
        listener = _TrafficListener(metric, traffic)
        messages.sparkSession.streams.addListener(listener)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = without_usable_text(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_results(result_messages(score_rows(usable(batch), model)), batch_id)
            unusable = rejected(batch)
            if not unusable.isEmpty():  # no empty files while all is well
                write_rejects(unusable, batch_id)
        finally:
            batch.unpersist()

    query = (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
    if listener is not None:
        listener.follow(query)
    return query


def replace_batch(path: str) -> BatchWriter:
    """Writer that keeps one Parquet folder per batch, ``path/batch=<id>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def received_messages(progress: Iterable) -> int:
    """Messages read by the batches of ``StreamingQuery.recentProgress``."""
    return sum(p["numInputRows"] for p in progress)
