"""Tables laid out by key, so that work per key needs no exchange.

Rows are stored in buckets by the hash of their key; a job that groups or joins by it
reads them where they are. A hot key would make one bucket, and so one task, long:
its rows, and those without a key, are stored beside the buckets instead, and
spread as usual. No key is in both parts, so a result per key is that of both together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.joins import ROWS_PER_TASK, exclude_keys, hot_keys
from riskweave.sources.tables import checked_path, write_parquet

_HOT = "_hot"


@dataclass(frozen=True)
class Bucketed:
    """Rows in buckets of ``key``, and the rows of hot keys or none."""

    name: str
    key: str
    even: DataFrame
    hot: DataFrame

    def rows(self) -> DataFrame:
        return self.even.unionAll(self.hot)

    def per_part(self, function: Callable[[DataFrame], DataFrame]) -> Bucketed:
        """The same layout after a function that treats each key by itself and keeps it."""
        return replace(self, even=function(self.even), hot=function(self.hot))

    def aggregate(self, *values: Column) -> Bucketed:
        return self.per_part(lambda part: part.groupBy(self.key).agg(*values))

    def excluding(self, keys: Bucketed, null_keys: str = "keep") -> Bucketed:
        """Rows whose key is not in ``keys``, which comes from the same table.

        The buckets meet where they are, whatever the number of keys; hot rows and
        rows without a key go the way of ``exclude_keys``.
        """
        if (keys.name, keys.key) != (self.name, self.key):
            raise ValueError(f"{keys.name} by {keys.key} is not laid out as {self.name}")
        even = self.even.join(keys.even.select(self.key), self.key, "left_anti")
        hot = exclude_keys(self.hot, keys.rows(), self.key, null_keys)
        return replace(self, even=even.select(self.even.columns), hot=hot)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    key: str,
    buckets: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> Bucketed:
    """Store ``df`` as catalog table ``name`` with its files at ``path``.

    Keys of more than ``rows_per_task`` rows are hot; their list is bounded as for
    salted joins. One file per bucket. Fails if the table or the path exists.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    root = checked_path(path).rstrip("/")
    hot = hot_keys(df, key, rows_per_task).select(key).withColumn(_HOT, F.lit(True))
    marked = df.join(F.broadcast(hot), key, "left")
    beside = F.col(_HOT).isNotNull() | F.col(key).isNull()
    write_parquet(marked.where(beside).select(df.columns), f"{root}/hot")
    (
        marked.where(~beside)
        .select(df.columns)
        .repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{root}/buckets")
        .saveAsTable(name)
    )
    return read_bucketed(df.sparkSession, name, root, key)


def read_bucketed(spark: SparkSession, name: str, path: str, key: str) -> Bucketed:
    even = spark.table(name)
    hot = spark.read.schema(even.schema).parquet(f"{checked_path(path).rstrip('/')}/hot")
    return Bucketed(name, key, even, hot)
