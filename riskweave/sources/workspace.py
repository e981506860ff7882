"""Shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the one set on the context.

    There is no default: on a cluster a machine-local folder would be lost with its
    machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the reliable checkpoint and cut its lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
