"""A corpus from documents to packed sequences, in stages that each write a Parquet table.

Toxic documents go, one document of each near-duplicate group stays, documents with
a passage of the benchmark go, personal data are masked, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import decontamination, packing, pii, simhash, toxicity
from riskweave.llm.queries import PATTERN, RANKS
from riskweave.sources.workspace import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model learned from the given labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of fingerprints linked at three bits."""
    return simhash.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by their kind."""
    return pii.without_personal_data(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.packed_pieces(docs, RANKS, PATTERN, with_ids=False)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("packing", packing_stage),
]

# Trained models, shingle hashes and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
