"""Experiment log: an append-only Parquet table of parameters, metrics and artifacts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.tables import checked_path

RUN_LOG_SCHEMA = "run_id string, kind string, key string, value string, ts timestamp"


@dataclass
class RunLog:
    """Writer for one run; entries are appended in one small file per call."""

    spark: SparkSession
    path: str
    experiment: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self) -> None:
        self.append("experiment", {"name": self.experiment})

    def append(self, kind: str, entries: Mapping[str, object]) -> None:
        rows = [(self.run_id, kind, key, str(value)) for key, value in entries.items()]
        (
            self.spark.createDataFrame(rows, "run_id string, kind string, key string, value string")
            .withColumn("ts", F.current_timestamp())
            .coalesce(1)
            .write.mode("append")
            .parquet(checked_path(self.path))
        )

    def params(self, entries: Mapping[str, object]) -> None:
        self.append("param", entries)

    def metrics(self, entries: Mapping[str, float]) -> None:
        self.append("metric", entries)

    def artifact(self, name: str, path: str) -> None:
        self.append("artifact", {name: path})


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(checked_path(path))
