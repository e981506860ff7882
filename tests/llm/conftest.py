from __future__ import annotations

import pytest

FIELDS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "score double, shard int, _id string, items string, starts string, fingerprint string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows, clashing column names."""
    long_text = " ".join(f"word{i % 9973}x{i % 13}" for i in range(60_000))
    texts = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long_text),
        (5, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (6, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (6, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (None, "one two"),
        (None, None),
        (7, "x"),
        (8, "12345 !!! ###"),
        (9, "Ärger über Straße 😀   end"),
    ]
    rows = [
        (doc, text, None if i % 3 else "en", None if i % 2 else "s", None, 0.5, 1, "a", "b", "c", "d")
        for i, (doc, text) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, FIELDS)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark_items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
