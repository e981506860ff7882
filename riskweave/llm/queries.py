"""Named queries of the text operators, each over its whole tables, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import (
    clustering,
    decontamination,
    filter_audit,
    language,
    licenses,
    oracles,
    packing,
    pii,
    quality,
    quality_rules,
    sharding,
    simhash,
    substring,
    toxicity,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # ids as in byte_bpe_50k.json
PATTERN = public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


def op3_sharding(spark, sf_dir):
    return sharding.shard_digest(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op5_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return language.predict_languages(docs, language.fit_languages(docs))


def op6_substring_dedup(spark, sf_dir):
    return substring.repeat_digest(_table(spark, sf_dir, "documents"))


def op7_pii(spark, sf_dir):
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.decontamination_digest(docs, items)


def op10_packing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return packing.packed_pieces(docs, RANKS, PATTERN, with_ids=False)


def op11_centroid_clustering(spark, sf_dir):
    return clustering.cluster_digest(_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return filter_audit.filter_interactions(docs, labels)


def op13_license_scan(spark, sf_dir):
    return licenses.license_digest(_table(spark, sf_dir, "documents"))


_QUERIES = (
    op1_simhash_near_dedup,
    op2_quality_classifier,
    op3_sharding,
    op4_toxicity,
    op5_language_id,
    op6_substring_dedup,
    op7_pii,
    op8_quality_rules,
    op9_decontamination,
    op10_packing,
    op11_centroid_clustering,
    op12_filter_audit,
    op13_license_scan,
)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


# Words as regular expressions of the SQL engine; windows of 13 words by position.
_SUBSTRING_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), starts AS (
    SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM words
), windows AS (
    SELECT r, doc_id, s, array_to_string(w[s:s + 12], ' ') AS win FROM starts
), firsts AS (
    SELECT win, min(doc_id) AS first FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT r, unnest(range(s, s + 13)) AS p
    FROM windows JOIN firsts USING (win) WHERE doc_id > first
), places AS (
    SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
    SELECT places.r, string_agg(word, ' ' ORDER BY places.p) AS text, count(*) AS n
    FROM places ANTI JOIN gone ON places.r = gone.r AND places.p = gone.p
    GROUP BY places.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r)
"""

_DECONTAMINATION_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item, w, least(10, len(w)) AS m FROM items WHERE len(w) > 0
), item_windows AS (
    SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS s FROM sized)
), lengths AS (
    SELECT DISTINCT m FROM sized
), doc_windows AS (
    SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
    FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM docs, lengths)
), hits AS (
    SELECT r, s, m, item FROM doc_windows JOIN item_windows USING (m, win)
), covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + m)) AS p FROM hits) GROUP BY r
), named AS (
    SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       covered.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def all_oracles() -> dict[str, str]:
    return {
        "op6_substring_dedup": _SUBSTRING_SQL,
        "op9_decontamination": _DECONTAMINATION_SQL,
        "op11_centroid_clustering": oracles.clustering_sql(),
        "op12_filter_audit": oracles.filter_audit_sql(),
        "op13_license_scan": oracles.license_sql(),
    }
