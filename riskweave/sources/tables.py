"""Batch sources and sinks: Parquet, CSV, catalog tables and fitted pipelines."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.schema import TRANSACTION_SCHEMA


def checked_path(path: str) -> str:
    """Reject paths whose scheme lost its colon, such as ``s3a//bucket/key``."""
    head = path.split("//", 1)[0]
    if "//" in path and head and not head.endswith(":") and "/" not in head:
        raise ValueError(f"malformed path: {path!r}")
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is at ``path``, in whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(checked_path(path))
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(hadoop_path)


def check_target(spark: SparkSession, path: str, mode: str = "errorifexists") -> str:
    """Refuse a malformed path, or one that is taken and not to be replaced, before any work."""
    if mode in ("error", "errorifexists") and exists(spark, path):
        raise FileExistsError(path)
    return path


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(checked_path(path))


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, TRANSACTION_SCHEMA)


RECORD = "_record"


def csv_options(delimiter: str = ",") -> dict[str, object]:
    """A header line that must match the schema, and malformed lines kept as ``RECORD``."""
    return {
        "header": True,
        "sep": delimiter,
        "enforceSchema": False,
        "columnPruning": False,  # a line counts as malformed whichever columns are read
        "columnNameOfCorruptRecord": RECORD,
    }


def with_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(RECORD).isNull()).drop(RECORD)


def malformed(lines: DataFrame) -> DataFrame:
    """Lines that do not fit the schema, as text beside what could be read of them."""
    return lines.where(F.col(RECORD).isNotNull())


def read_csv_lines(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ","
) -> DataFrame:
    """CSV files (a glob is fine), with the text of each malformed line in ``RECORD``."""
    reader = spark.read.schema(with_record(schema)).options(**csv_options(delimiter))
    return reader.csv(checked_path(path))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ","
) -> DataFrame:
    """CSV files (a glob is fine) with a header line and a declared schema.

    A malformed line is an error; ``read_csv_lines`` keeps such lines apart.
    """
    options = csv_options(delimiter) | {"mode": "FAILFAST"}
    return spark.read.schema(schema).options(**options).csv(checked_path(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog (a Hive metastore where the session has one)."""
    return spark.table(name)


def laid_out(
    df: DataFrame, partitions: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Repartition only where asked; otherwise AQE sizes the output partitions.

    Without keys the rows go round-robin, which no hot key can unbalance. Give
    keys only where no value of theirs is hot, or add a second, finer one.
    """
    if partitions is None:
        return df.repartition(*keys) if keys else df
    return df.repartition(partitions, *keys)


# Fixed value: fewer rows are not worth a task of their own, where a job has thousands of stages.
LEAST_ROWS_PER_TASK = 50_000


def even_partitions(rows: int, cores: int, most: int) -> int:
    """Partitions of even size: up to one per core for few rows, ``most`` rows in each at most."""
    few = min(cores, math.ceil(rows / LEAST_ROWS_PER_TASK))
    return max(1, few, math.ceil(rows / most))


def spread(df: DataFrame, rows: int, most: int, at_once: int = 1) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt out evenly, with ``most`` rows a task at most.

    For work that makes much of small rows. The scan's own partitions go by bytes, and
    may all but a few be empty: files have few row groups, and filters leave rows in some.
    Where ``at_once`` jobs read the rows at the same time, each gets its share of the cores.
    """
    cores = math.ceil(df.sparkSession.sparkContext.defaultParallelism / at_once)
    return laid_out(df, even_partitions(rows, cores, most))


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partitions: int | None = None,
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Write Parquet, in folders by the columns ``partition_by``.

    Folders are filled from partitions AQE balances: large ones are split and
    small ones merged, so a folder gets few files and no task a whole hot folder.
    """
    if partition_by and partitions is None and not keys:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = laid_out(df, partitions, keys).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(checked_path(path))


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None
) -> None:
    laid_out(df, partitions).write.mode(mode).csv(checked_path(path), header=True)


def save_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    writer = model.write().overwrite() if overwrite else model.write()
    writer.save(checked_path(path))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(checked_path(path))
