"""Trials of a search, kept so that a search that was ended can go on.

Each finished trial is a small file named by a hash of all that decides its outcome:
the rows, the split, the share of rows fitted on and every parameter. A later search
with the same hash takes the outcome from there instead of fitting again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.commits import publish
from riskweave.sources.tables import checked_path, exists

TRIAL = "key string, parameters string, share double, auc double"


def data_digest(data: DataFrame) -> str:
    """A digest of the rows, whatever their order and partitions: one scan, three numbers.

    Repeated rows count: sums, not only exclusive-or, go into it.
    """
    row = F.xxhash64(*[F.col(c) for c in sorted(data.columns)])
    # NULLs leave a hash as it is, so where they stand is hashed too.
    missing = F.xxhash64(row, *[F.col(c).isNull() for c in sorted(data.columns)])
    found = data.select(row.alias("a"), missing.alias("b")).agg(
        F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.bit_xor("b")
    )
    return hashlib.sha256(repr((sorted(data.columns), *map(str, found.first()))).encode()).hexdigest()


def trial_key(digest: str, share: float, parameters: Mapping[str, object]) -> str:
    told = json.dumps([digest, share, sorted((k, repr(v)) for k, v in parameters.items())])
    return hashlib.sha256(told.encode()).hexdigest()


@dataclass(frozen=True)
class TrialStore:
    """Finished trials as files under one shared folder."""

    spark: SparkSession
    path: str

    def known(self) -> dict[str, float]:
        """Outcomes by key; the driver holds one number for each trial."""
        if not exists(self.spark, self.path):
            return {}
        rows = self.spark.read.schema(TRIAL).option("pathGlobFilter", "*.json").json(self.path)
        return {r["key"]: r["auc"] for r in rows.select("key", "auc").collect()}

    def record(self, key: str, parameters: Mapping[str, object], share: float, auc: float) -> None:
        """Keep one outcome; if another search has just kept the same one, that stays."""
        entry = {
            "key": key,
            "parameters": json.dumps({k: repr(v) for k, v in sorted(parameters.items())}),
            "share": share,
            "auc": auc,
        }
        target = f"{checked_path(self.path).rstrip('/')}/{key}.json"
        try:
            publish(self.spark, target, json.dumps(entry))
        except Exception:
            if not exists(self.spark, target):
                raise

    def table(self) -> DataFrame:
        return self.spark.read.schema(TRIAL).option("pathGlobFilter", "*.json").json(self.path)
