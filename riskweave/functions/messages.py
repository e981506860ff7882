"""JSON envelopes of the scoring loop.

In:  ``{"ts", "card_id", "features"}``; ``features`` is itself JSON text of one
     row laid out by column, ``{"V26": {"0": 1.0}, ...}``; any one row key will do.
Out: ``{"ts", "card_id", "result"}``; ``result`` is JSON text of
     ``{"TransactionID", "card1", "probability_"}``.
The message key is the card id in decimal.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ENVELOPE_SCHEMA = "ts string, card_id bigint, features string"
RESULT_ENVELOPE_SCHEMA = "ts string, card_id bigint, result string"
RESULT_SCHEMA = "TransactionID bigint, card1 bigint, probability_ double"

_ROW = "0"
_KEEP_NULLS = {"ignoreNullFields": "false"}


def iso_now() -> Column:
    """Current time as ISO text in the session zone, without an offset."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def message_key(card: Column) -> Column:
    return card.cast("string").cast("binary")


def features_json(columns: Iterable[str]) -> Column:
    """One row as column-oriented JSON; NULLs are written out."""
    cells = [F.struct(F.col(name).alias(_ROW)).alias(name) for name in columns]
    return F.to_json(F.struct(*cells), _KEEP_NULLS)


def input_envelope(columns: Iterable[str], card: Column, ts: Column | None = None) -> Column:
    body = F.struct(
        (iso_now() if ts is None else ts).alias("ts"),
        card.cast("bigint").alias("card_id"),
        features_json(columns).alias("features"),
    )
    return F.to_json(body, _KEEP_NULLS)


def result_envelope(
    transaction: Column, card: Column, probability: Column, ts: Column | None = None
) -> Column:
    result = F.struct(
        transaction.alias("TransactionID"),
        card.alias("card1"),
        probability.alias("probability_"),
    )
    body = F.struct(
        (iso_now() if ts is None else ts).alias("ts"),
        card.cast("bigint").alias("card_id"),
        F.to_json(result, _KEEP_NULLS).alias("result"),
    )
    return F.to_json(body, _KEEP_NULLS)


def _parsed(text: Column, schema: str) -> Column:
    """Fields of a JSON object; ``_corrupt_record`` is set where it does not parse."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(text, f"{schema}, {CORRUPT} string", options)


def parse_envelope(value: Column) -> Column:
    return _parsed(value.cast("string"), ENVELOPE_SCHEMA)


def _is_integer(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.IntegralType)


def parse_features(features: Column, schema: T.StructType) -> Column:
    """A struct of columns, each a map from row key to cell. Integers may arrive as 9
    or 9.0, so they are read as decimals, which keep all 64 bits.
    """
    cells = [
        f"`{f.name}` map<string, {'decimal(38,10)' if _is_integer(f) else 'double'}>"
        for f in schema.fields
    ]
    return _parsed(features, ", ".join(cells))


def row_count(features: Column, schema: T.StructType) -> Column:
    """Number of different row keys over all columns; a key given twice counts twice."""
    keys = [F.coalesce(F.map_keys(features[f.name]), _no_keys()) for f in schema.fields]
    most = F.greatest(*[F.size(k) for k in keys])
    return F.greatest(F.size(F.array_distinct(F.concat(*keys))), most)


def _no_keys() -> Column:
    return F.array().cast("array<string>")


def _cell(features: Column, field: T.StructField) -> Column:
    return F.get(F.map_values(features[field.name]), F.lit(0))


def feature_value(features: Column, field: T.StructField) -> Column:
    """One cell in its declared type; NULL when it is absent or out of range."""
    cell = _cell(features, field)
    return cell.try_cast(field.dataType) if _is_integer(field) else cell


def misfit(features: Column, schema: T.StructType) -> Column:
    """Whether some integer cell has a fraction or does not fit its type."""
    misfits = []
    for field in filter(_is_integer, schema.fields):
        cell = _cell(features, field)
        lost = feature_value(features, field).isNull() | (cell != F.floor(cell))
        misfits.append(cell.isNotNull() & lost)
    return reduce(Column.__or__, misfits, F.lit(False))
