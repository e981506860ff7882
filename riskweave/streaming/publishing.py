"""Results that count once, however often their messages were sent.

A result carries the place of the message it answers, ``topic/partition/offset``, as a
Kafka header. When a batch is repeated after a failure its results are sent again, as
new messages of the results topic, but with the same origin; whoever reads them keeps
the first of each origin. State is kept for origins of the last while only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORIGIN = "origin"
PLACE = ("topic", "partition", "offset")
HEADERS = "array<struct<key: string, value: binary>>"
MESSAGE_SCHEMA = f"key binary, value binary, headers {HEADERS}"


def place(messages: DataFrame) -> Column:
    """``topic/partition/offset`` as text; NULL where one is missing."""
    if not set(PLACE) <= set(messages.columns):
        return F.lit(None).cast("string")
    whole = F.lit(True)
    for name in PLACE:
        whole &= F.col(name).isNotNull()
    return F.when(whole, F.concat_ws("/", *PLACE))  # a topic's name has no slash


def origin_headers(origin: Column) -> Column:
    """Headers of a result: its origin, or none."""
    header = F.struct(F.lit(ORIGIN).alias("key"), origin.cast("binary").alias("value"))
    return F.when(origin.isNotNull(), F.array(header)).cast(HEADERS)


def origin_of(headers: Column) -> Column:
    """The origin among the headers of a result; NULL without one."""
    named = F.filter(headers, lambda header: header["key"] == ORIGIN)
    return F.get(named, F.lit(0))["value"].cast("string")


def first_of_each_origin(results: DataFrame, within: str = "1 day") -> DataFrame:
    """Results (with ``headers``) without those whose origin was there before; adds ``origin``.

    In a stream a repeat is known if it arrives within ``within`` of the first. Time is
    the arrival at this query, so no result is ever too late to be kept, and state
    holds the origins of that while, spread by origin. In a batch all rows count.
    Which of several results of an origin stays is open: they answer the same message.
    Results without an origin are all kept.
    """
    marked = results.withColumn(ORIGIN, origin_of(F.col("headers")))
    known, unknown = marked.where(F.col(ORIGIN).isNotNull()), marked.where(F.col(ORIGIN).isNull())
    if not results.isStreaming:
        return known.dropDuplicates([ORIGIN]).unionByName(unknown)
    arrived = "_arrived"
    while arrived in marked.columns:
        arrived += "_"
    first = (
        known.withColumn(arrived, F.current_timestamp())
        .withWatermark(arrived, within)
        .dropDuplicatesWithinWatermark([ORIGIN])
        .drop(arrived)
    )
    return first.unionByName(unknown)
