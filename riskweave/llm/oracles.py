"""SQL of the clustering, the filter audit and the license scan, built from their parameters."""

from __future__ import annotations

from itertools import permutations

from riskweave.llm import clustering, filter_audit, licenses

_FLOOR = "(s - ((s % n) + n) % n) // n"


def clustering_sql(rounds: int = clustering.ROUNDS) -> str:
    """Full scans in every round; each round is two common table expressions."""
    k, size, seed = clustering.CLUSTERS, clustering.COMPONENTS, clustering.SEED
    parts = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor({clustering.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
), cells AS MATERIALIZED (
    SELECT r, unnest(range(1, {size + 1})) AS i, unnest(v) AS x FROM kept
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
    FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {k})
)"""
    ]
    for step in range(rounds + 1):
        parts.append(f"""a{step} AS MATERIALIZED (
    SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
    FROM (SELECT r, c, CAST(list_sum(list_transform(list_zip(kept.v, c{step}.v),
                 lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
          FROM kept CROSS JOIN c{step})
    GROUP BY r
)""")
        if step < rounds:
            parts.append(f"""c{step + 1} AS MATERIALIZED (
    SELECT c{step}.c, coalesce(m.v, c{step}.v) AS v
    FROM c{step} LEFT JOIN (
        SELECT c, list(CAST({_FLOOR} AS BIGINT) ORDER BY i) AS v
        FROM (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
              FROM a{step} JOIN cells USING (r) GROUP BY c, i)
        GROUP BY c) m USING (c)
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, a{rounds}.c AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.c = a{rounds}.c"""


def filter_audit_sql() -> str:
    """Every document against every step of every order."""
    letters = filter_audit.FILTERS
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(letters))
    flags = "CASE f " + " ".join(f"WHEN '{x}' THEN {x}" for x in letters) + " END"
    earlier = " OR ".join(f"({x} AND position('{x}' IN o) < step)" for x in letters)
    n_fails = " + ".join(f"CAST({x} AS INTEGER)" for x in letters)
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS first FROM texts GROUP BY t
), marks AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), docs AS MATERIALIZED (
    SELECT part, len(w) < 50 AS A, 100 * len(list_distinct(w)) < 65 * len(w) AS B,
           100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) AS C,
           regexp_matches(t, '[#$%&*|]') AS D, coalesce(doc_id > first, false) AS E,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM texts JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
), kinds AS MATERIALIZED (
    SELECT part, A, B, C, D, E, good, toxic, count(*) AS n FROM docs GROUP BY ALL
), steps AS (
    SELECT o, step, substr(o, CAST(step AS INTEGER), 1) AS f
    FROM (VALUES {orders}) AS t(o) CROSS JOIN (SELECT unnest(range(1, 6)) AS step)
), judged AS (
    SELECT part, o, step, f, n, good, toxic, {flags} AS fails, ({earlier}) AS gone, {n_fails} AS n_fails
    FROM kinds CROSS JOIN steps
), counted AS (
    SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, f,
           sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY part, o, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""


def license_sql() -> str:
    """Phrases at every place, notices against every block."""
    phrases = ", ".join(
        f"('{t.label}', {str(t.base).lower()}, '{t.words}', '{t.words.split()[0]}', {len(t.words.split())})"
        for t in licenses.TEMPLATES
        if t.together
    )
    notices = ", ".join(
        f"('{t.label}', {list(t.distinct)}, {t.needed})" for t in licenses.TEMPLATES if not t.together
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), phrases AS (
    SELECT * FROM (VALUES {phrases}) AS t(label, base, words, word, m)
), notices AS (
    SELECT * FROM (VALUES {notices}) AS t(label, words, needed)
), places AS (
    SELECT r, w, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs
), named AS (
    SELECT r, label, base, p, 1.0::DOUBLE AS share
    FROM places JOIN phrases USING (word)
    WHERE array_to_string(w[p + 1:p + m], ' ') = words
), blocks AS (
    SELECT r, w[p + 1:p + {licenses.BLOCK}] AS b
    FROM (SELECT r, w, unnest(range(0, len(w), {licenses.STRIDE})) AS p FROM docs)
), held AS (
    SELECT r, label, needed, len(list_intersect(b, words)) AS n, len(words) AS m
    FROM blocks CROSS JOIN notices
), found AS (
    SELECT r, label, base, p, share FROM named
    UNION ALL
    SELECT r, label, false, NULL, CAST(n AS DOUBLE) / m FROM held WHERE n >= needed
), summed AS (
    SELECT r, count(*) FILTER (WHERE base) AS n_base, min(p) FILTER (WHERE base) AS first_word,
           max(p) FILTER (WHERE base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM docs LEFT JOIN summed USING (r)"""
