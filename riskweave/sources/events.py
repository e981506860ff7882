"""Card transactions derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.schema import TRANSACTION_SCHEMA

WEEK_CUTOFF = 7 * 24 * 3600


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _missing_every(n: int, value: Column) -> Column:
    return F.when(F.col("event_id") % n != 0, value)


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Events recast as card transactions; some features are missing by event id."""
    event, user, value, kind = (
        F.col(c) for c in ("event_id", "user_id", "value", "event_type")
    )
    columns = {
        "TransactionID": event,
        "TransactionDT": F.expr(
            "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)"
        ),
        "card1": user,
        "isFraud": F.when((kind == "error") & (value > 120), 1).otherwise(0),
        "V26": _missing_every(
            11, F.when(kind == "click", 0).when(kind == "view", 2).otherwise(1)
        ),
        "V286": _missing_every(13, F.when(kind == "signup", 3).otherwise(0)),
        "addr1": _missing_every(19, 100 + (user * 37) % 500),
        "addr2": _missing_every(23, 60 + user % 40),
        "C7": _missing_every(7, value / 10),
        "V97": _missing_every(17, F.floor(value / 10)),
        "V183": event % 6,
        "V236": event % 5,
        "V279": event % 8,
        "V280": event % 12,
        "V290": event % 4 + 1,
        "V306": value * 4,
        "V308": value * 8,
        "V317": _missing_every(29, value * 9),
    }
    return events.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in TRANSACTION_SCHEMA.fields]
    )


def read_event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_events(spark, sf_dir))
