"""The same queries in plain SQL for an independent engine, keyed by query name."""

from __future__ import annotations

import math
from itertools import combinations

# Spelled out here, so that a wrong list or threshold of the library would show.
BINARY_FEATURES = ["V286", "V26"]
DISCRETE_FEATURES = ["weekdays", "minutes"]
CONTINUOUS_FEATURES = [
    "addr1", "addr2", "C7", "V97", "V183", "V236",
    "V279", "V280", "V290", "V306", "V308", "V317",
]
CAP_THRESHOLDS = {
    "addr1": 540.0,
    "addr2": 87.0,
    "C7": 10.0,
    "V97": 7.0,
    "V183": 4.0,
    "V236": 3.0,
    "V279": 5.0,
    "V280": 9.0,
    "V290": 3.0,
    "V306": 938.0,
    "V308": 1649.5,
    "V317": 1762.0,
}

_CUTOFF = 604800

_TRANSACTIONS = """
tx AS (
  SELECT event_id AS "TransactionID",
         date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)::BIGINT AS "TransactionDT",
         (CASE WHEN event_type = 'error' AND value > 120 THEN 1 ELSE 0 END)::INTEGER AS "isFraud",
         user_id AS card1,
         (CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_type = 'signup' THEN 3
               ELSE 0 END)::DOUBLE AS "V286",
         (CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_type = 'click' THEN 0
               WHEN event_type = 'view' THEN 2 ELSE 1 END)::DOUBLE AS "V26",
         (CASE WHEN event_id % 19 = 0 THEN NULL ELSE 100 + (user_id * 37) % 500 END)::DOUBLE AS addr1,
         (CASE WHEN event_id % 23 = 0 THEN NULL ELSE 60 + user_id % 40 END)::DOUBLE AS addr2,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 10 END AS "C7",
         (CASE WHEN event_id % 17 = 0 THEN NULL ELSE floor(value / 10) END)::DOUBLE AS "V97",
         (event_id % 6)::DOUBLE AS "V183",
         (event_id % 5)::DOUBLE AS "V236",
         (event_id % 8)::DOUBLE AS "V279",
         (event_id % 12)::DOUBLE AS "V280",
         (event_id % 4 + 1)::DOUBLE AS "V290",
         value * 4 AS "V306",
         value * 8 AS "V308",
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE value * 9 END AS "V317"
  FROM events
)"""

_MISSING_CARDS = """
tm AS (
  SELECT * REPLACE (CASE WHEN "TransactionID" % 31 = 0 THEN NULL ELSE card1 END AS card1) FROM tx
)"""


def _capped(column: str) -> str:
    cap = f"{CAP_THRESHOLDS[column]}::DOUBLE"
    return f'CASE WHEN "{column}" IS NULL THEN NULL ELSE least("{column}", {cap}) END'


def _binary(column: str) -> str:
    return f'CASE WHEN "{column}" > 0 THEN 1.0::DOUBLE ELSE "{column}" END'


_TIME_PARTS = """
  trunc(("TransactionDT" % 604800) / 86400.0::DOUBLE)::INTEGER AS weekdays,
  trunc(("TransactionDT" % 86400) / 3600.0::DOUBLE)::INTEGER AS hours,
  trunc(("TransactionDT" % 86400 % 3600) / 60.0::DOUBLE)::INTEGER AS minutes"""

_PREPARED = (
    'prep AS (\n  SELECT "TransactionID", "TransactionDT", "isFraud", card1,\n  '
    + ",\n  ".join(
        [f'coalesce({_binary(c)}, -999.0::DOUBLE) AS "{c}"' for c in BINARY_FEATURES]
        + [
            f'coalesce({_binary(c)}, -999.0::DOUBLE)::VARCHAR AS "{c}_str"'
            for c in BINARY_FEATURES
        ]
        + [f'coalesce({_capped(c)}, 0.0::DOUBLE) AS "{c}"' for c in CONTINUOUS_FEATURES]
    )
    + ","
    + _TIME_PARTS
    + "\n  FROM tx\n)"
)


def _with(*tables: str, body: str) -> str:
    return "WITH " + ",".join(tables) + "\n" + body.strip()


def _tx(body: str) -> str:
    return _with(_TRANSACTIONS, body=body)


def _prep(body: str, *more: str) -> str:
    return _with(_TRANSACTIONS, _PREPARED, *more, body=body)


def _names(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


_VALID = f"""
bad AS (
  SELECT DISTINCT card1 FROM tx
  WHERE "TransactionDT" < {_CUTOFF} AND "isFraud" = 1 AND card1 IS NOT NULL
),
valid AS (
  SELECT * FROM tx WHERE "TransactionDT" >= {_CUTOFF} AND card1 NOT IN (SELECT card1 FROM bad)
)"""


def _top(score: str, name: str = "top") -> str:
    return f"""
{name} AS (
  SELECT card1, max("{score}") AS max_score, max("isFraud") AS max_label,
         row_number() OVER (ORDER BY max("{score}") DESC NULLS LAST, card1 NULLS LAST) - 1 AS position
  FROM valid GROUP BY card1
  QUALIFY position < 50
)"""


def _draws(top: str = "top", name: str = "draws") -> str:
    return f"""
{name} AS (
  SELECT i.i AS iteration, j.j AS draw, t.position, t.max_label AS label
  FROM range(100) AS i(i), range(50) AS j(j), {top} AS t
  WHERE j.j < (SELECT count(*) FROM {top})
    AND t.position = concat('0x', substr(md5(concat('25:', i.i, ':', j.j)), 1, 8))::BIGINT
                     % (SELECT count(*) FROM {top})
)"""


def _precision(draws: str = "draws", name: str = "prec") -> str:
    return f"""
{name} AS (
  SELECT iteration, sum(label)::DOUBLE / 50 AS precision FROM {draws} GROUP BY iteration
)"""


_BOOTSTRAP = (_TRANSACTIONS, _VALID, _top("V317"), _draws(), _precision())


def _bits(column: str) -> str:
    return f"""
bits_{column} AS (
  SELECT value, string_agg(CASE WHEN slot = index THEN '1' ELSE '0' END, '' ORDER BY slot) AS bits
  FROM (SELECT "{column}_str" AS value,
               row_number() OVER (ORDER BY count(*) DESC, "{column}_str") - 1 AS index
        FROM prep GROUP BY 1),
       (SELECT unnest(range((SELECT count(DISTINCT "{column}_str") FROM prep))) AS slot)
  GROUP BY value
)"""


_ONE_HOT = tuple(_bits(c) for c in BINARY_FEATURES)

_MIN_MAX = ", ".join(
    f'("{c}" - min("{c}") OVER ()) * (1.0::DOUBLE / (max("{c}") OVER () - min("{c}") OVER ()))'
    f" AS {c}_scaled"
    for c in DISCRETE_FEATURES
)

_SPREADS = (
    "spread AS (SELECT "
    + ", ".join(
        f'quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) AS "{c}_iqr"'
        for c in CONTINUOUS_FEATURES
    )
    + " FROM prep)"
)

_ROBUST = ", ".join(
    f'CASE WHEN "{c}_iqr" = 0 THEN 0.0::DOUBLE ELSE "{c}" * (1.0::DOUBLE / "{c}_iqr") END AS "{c}_scaled"'
    for c in CONTINUOUS_FEATURES
)

_VECTOR_PARTS = (
    "parts AS (\n"
    + "\n UNION ALL ".join(
        [
            f"""SELECT "TransactionID", {i} AS part, (unnest(range(length(bits))) + 1) AS place,
       unnest(string_split(bits, ''))::DOUBLE AS value
 FROM prep JOIN bits_{c} ON value = "{c}_str" """
            for i, c in enumerate(BINARY_FEATURES)
        ]
        + [
            f'SELECT "TransactionID", 2 AS part, {i} AS place, {c}_scaled AS value FROM mm'
            for i, c in enumerate(DISCRETE_FEATURES)
        ]
        + [
            f'SELECT "TransactionID", 3 AS part, {i} AS place, "{c}_scaled" AS value FROM rs'
            for i, c in enumerate(CONTINUOUS_FEATURES)
        ]
    )
    + "\n)"
)

_FEATURE_ARRAY = _prep(
    """
SELECT "TransactionID",
       (row_number() OVER (PARTITION BY "TransactionID" ORDER BY part, place) - 1)::INTEGER AS slot,
       value
FROM parts
""",
    *_ONE_HOT,
    _SPREADS,
    f' mm AS (SELECT "TransactionID", {_MIN_MAX} FROM prep)',
    f' rs AS (SELECT "TransactionID", {_ROBUST} FROM prep, spread)',
    _VECTOR_PARTS,
)

_AUC = """
groups AS (
  SELECT coalesce("V317", 0.0::DOUBLE) AS score, sum("isFraud") AS pos, sum(1 - "isFraud") AS neg
  FROM tx GROUP BY 1
),
ranked AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (
    ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM groups
),
auc AS (
  SELECT sum(pos * (2 * below + neg))::DOUBLE
           / (2.0::DOUBLE * sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc,
         sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives
  FROM ranked
)"""


def _far(column: str) -> str:
    return f"""max("{column}") - quantile_cont("{column}", 0.99) > stddev_samp("{column}")"""


# The upper tail from the series of the lower one; 4 features, so i / 4 of 0.05 for the i-th.
_CHI_SQUARE_SELECTION = _with(
    _TRANSACTIONS,
    f"""
timed AS (SELECT *, {_TIME_PARTS} FROM tx),
counts AS ("""
    + " UNION ALL ".join(
        f"""
  SELECT '{c}' AS feature, sum("isFraud") AS p, count(*) AS n FROM timed GROUP BY "{c}" """
        for c in [*BINARY_FEATURES, "weekdays", "hours"]
    )
    + """
),
chi AS (
  SELECT feature, count(*) AS categories, count(*) - 1 AS dof,
         sum(pow(p - n * share, 2) / (n * share)
             + pow(n - p - n * (1 - share), 2) / (n * (1 - share))) AS x
  FROM counts, (SELECT avg("isFraud") AS share FROM tx) GROUP BY feature
),
tail AS (
  SELECT *, greatest(0, 1 - list_sum(list_transform(range(3000), lambda i:
           exp((dof / 2.0 + i) * ln(x / 2) - x / 2 - lgamma(dof / 2.0 + i + 1))))) AS p
  FROM chi
),
ranked AS (SELECT *, row_number() OVER (ORDER BY p) AS i FROM tail)""",
    body="""
SELECT feature, categories, dof, round(x, 6) AS chi_square, round(p, 6) AS p_value,
       i <= (SELECT coalesce(max(i), 0) FROM ranked WHERE p <= 0.05 * i / 4) AS selected
FROM ranked""",
)

_POISSON_BOUNDS = [
    math.floor(sum(math.exp(-1) / math.factorial(j) for j in range(w + 1)) * 2**32) for w in range(12)
]

_POISSON_BOOTSTRAP = _with(
    _TRANSACTIONS,
    _VALID,
    f"""
cards AS (
  SELECT card1, max("V317") AS max_score, max("isFraud") AS max_label FROM valid GROUP BY card1
),
weighted AS (
  SELECT i.i AS iteration, card1, max_score, max_label,
         len(list_filter({_POISSON_BOUNDS}, lambda b: b <= concat('0x', substr(
           md5(concat('25:', card1, ':', i.i // 4)), CAST(8 * (i.i % 4) + 1 AS INTEGER), 8))::BIGINT)) AS w
  FROM cards, range(100) AS i(i)
),
placed AS (
  SELECT *, coalesce(sum(w) OVER (PARTITION BY iteration
    ORDER BY max_score DESC NULLS LAST, card1 NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM weighted
)""",
    body="""
SELECT iteration::INTEGER AS iteration,
       sum(CASE WHEN before < 50 THEN least(w, 50 - before) * max_label ELSE 0 END)::DOUBLE / 50 AS precision
FROM placed GROUP BY iteration""",
)

_AUC_COVARIANCE = _with(
    _TRANSACTIONS,
    """
scored AS (
  SELECT "isFraud" = 1 AS positive, coalesce("V280", 0.0) AS a, coalesce("V317", 0.0) AS b FROM tx
),
sizes AS (
  SELECT count(*) FILTER (WHERE positive)::DOUBLE AS m, count(*) FILTER (WHERE NOT positive)::DOUBLE AS n
  FROM scored
),
below AS (
  SELECT positive,
         (count(*) FILTER (WHERE NOT positive) OVER (ORDER BY a RANGE UNBOUNDED PRECEDING)
          - count(*) FILTER (WHERE NOT positive) OVER (PARTITION BY a) / 2.0)::DOUBLE AS neg_a,
         (count(*) FILTER (WHERE NOT positive) OVER (ORDER BY b RANGE UNBOUNDED PRECEDING)
          - count(*) FILTER (WHERE NOT positive) OVER (PARTITION BY b) / 2.0)::DOUBLE AS neg_b,
         (count(*) FILTER (WHERE positive) OVER (ORDER BY a RANGE UNBOUNDED PRECEDING)
          - count(*) FILTER (WHERE positive) OVER (PARTITION BY a) / 2.0)::DOUBLE AS pos_a,
         (count(*) FILTER (WHERE positive) OVER (ORDER BY b RANGE UNBOUNDED PRECEDING)
          - count(*) FILTER (WHERE positive) OVER (PARTITION BY b) / 2.0)::DOUBLE AS pos_b
  FROM scored
),
placed AS (
  SELECT positive, CASE WHEN positive THEN neg_a / n ELSE (m - pos_a) / m END AS a,
         CASE WHEN positive THEN neg_b / n ELSE (m - pos_b) / m END AS b
  FROM below, sizes
),
parts AS (
  SELECT positive, avg(a) AS a, avg(b) AS b, var_samp(a) / count(*) AS aa, var_samp(b) / count(*) AS bb,
         covar_samp(a, b) / count(*) AS ab
  FROM placed GROUP BY positive
),
whole AS (
  SELECT max(a) FILTER (WHERE positive) AS a, max(b) FILTER (WHERE positive) AS b,
         sum(aa) AS aa, sum(bb) AS bb, sum(ab) AS ab FROM parts
)""",
    body="""
SELECT round(a, 9) AS auc1, round(b, 9) AS auc2, round((a - b) / sqrt(aa + bb - 2 * ab), 9) AS z,
       round(aa * 1e6, 6) AS var1, round(bb * 1e6, 6) AS var2, round(ab * 1e6, 6) AS covariance,
       m::BIGINT AS positives, n::BIGINT AS negatives
FROM whole, sizes""",
)

_MONTHS = "SELECT month(o_orderdate)::INTEGER AS \"Month\", count(*) AS n FROM orders GROUP BY 1"

_SENSORS = """
SELECT CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id END AS device_id,
       ts::VARCHAR AS ts, value
FROM events"""

_SCORING_NAMES = ["TransactionID", "TransactionDT", "card1", *BINARY_FEATURES, *CONTINUOUS_FEATURES]
_STAMP = "2024-02-01T00:00:00.000000"


def all_oracles() -> dict[str, str]:
    whole = _tx("SELECT * FROM tx")
    one_hot_columns = ", ".join(f'bits_{c}.bits AS "onehot_{c}"' for c in BINARY_FEATURES)
    one_hot_joins = " ".join(
        f'JOIN bits_{c} ON bits_{c}.value = "{c}_str"' for c in BINARY_FEATURES
    )
    quartiles = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, quantile_cont("{c}", 0.25) AS q25,
        quantile_cont("{c}", 0.5) AS q50, quantile_cont("{c}", 0.75) AS q75 FROM tx"""
        for c in CONTINUOUS_FEATURES
    )
    labels = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, "{c}_str" AS label, count(*) AS n,
        row_number() OVER (ORDER BY count(*) DESC, "{c}_str") - 1 AS index
        FROM prep GROUP BY "{c}_str" """
        for c in BINARY_FEATURES
    )
    discrete = _prep(
        f'SELECT "TransactionID", {one_hot_columns}, {_MIN_MAX} FROM prep {one_hot_joins}',
        *_ONE_HOT,
    )
    denied = f"""
WITH readings AS ({_SENSORS})
SELECT device_id, value FROM readings r
WHERE NOT EXISTS (
  SELECT 1 FROM readings d WHERE d.value > 250 AND d.device_id = r.device_id)"""
    split_with_missing = _with(
        _TRANSACTIONS,
        _MISSING_CARDS,
        body=f"""
SELECT * FROM tm WHERE "TransactionDT" >= {_CUTOFF} AND card1 NOT IN (
  SELECT card1 FROM tm
  WHERE "TransactionDT" < {_CUTOFF} AND "isFraud" = 1 AND card1 IS NOT NULL)""",
    )
    card_scores = _with(
        _TRANSACTIONS,
        _MISSING_CARDS,
        f"""
kept AS (
  SELECT * FROM tm WHERE "TransactionDT" >= {_CUTOFF} AND card1 NOT IN (
    SELECT card1 FROM tm
    WHERE "TransactionDT" < {_CUTOFF} AND "isFraud" = 1 AND card1 IS NOT NULL)
)""",
        body="""
SELECT card1, max("V317") AS max_score, max("isFraud") AS max_label FROM kept GROUP BY card1""",
    )
    return {
        "transactions_scan": whole,
        "parquet_roundtrip": whole,
        "csv_roundtrip": whole,
        "catalog_table": whole,
        "repartitioned_output": _tx('SELECT "TransactionID", card1 FROM tx'),
        "row_count": _tx("SELECT count(*) AS n FROM tx"),
        "group_count_by_month": _MONTHS,
        "month_counts_csv": _MONTHS,
        "binarize": _tx(
            f'SELECT "TransactionID", {", ".join(_binary(c) + chr(32) + f"AS {chr(34)}{c}{chr(34)}" for c in BINARY_FEATURES)} FROM tx'
        ),
        "cap_outliers": _tx(
            'SELECT "TransactionID", '
            + ", ".join(f'{_capped(c)} AS "{c}"' for c in CONTINUOUS_FEATURES)
            + " FROM tx"
        ),
        "time_parts": _tx(f'SELECT "TransactionID", {_TIME_PARTS} FROM tx'),
        "fill_nulls": _tx(
            'SELECT "TransactionID", '
            + ", ".join(
                f'coalesce("{c}", 0.0::DOUBLE) AS "{c}_filled"' for c in CONTINUOUS_FEATURES
            )
            + " FROM tx"
        ),
        "discrete_to_string": _tx(
            'SELECT "TransactionID", '
            + ", ".join(f'"{c}"::VARCHAR AS "{c}_str"' for c in BINARY_FEATURES)
            + " FROM tx"
        ),
        "feature_prep_chain": _prep("SELECT * FROM prep"),
        "fraud_transactions": _tx(
            'SELECT "TransactionID", card1, "isFraud" FROM tx WHERE "isFraud" = 1'
        ),
        "temporal_split_train": _tx(f'SELECT * FROM tx WHERE "TransactionDT" < {_CUTOFF}'),
        "compromised_cards": _with(_TRANSACTIONS, _VALID, body="SELECT card1 FROM bad"),
        "temporal_split_valid": _with(_TRANSACTIONS, _VALID, body="SELECT * FROM valid"),
        "split_with_missing_cards": split_with_missing,
        "split_beyond_broadcast": split_with_missing,
        "bucketed_card_scores": card_scores,
        "bucketed_hot_card_scores": card_scores,
        "split_without_frauds": _with(_TRANSACTIONS, _MISSING_CARDS, body="SELECT * FROM tm"),
        "denylist_anti_join": denied,
        "denylist_beyond_broadcast": denied,
        "hash_split": _tx(
            """
SELECT "TransactionID",
       CASE WHEN concat('0x', substr(md5(concat('42:', "TransactionID")), 1, 8))::BIGINT % 1000 < 800
            THEN 'train' ELSE 'held_out' END AS part
FROM tx"""
        ),
        "hash_sample": _tx(
            """
SELECT "TransactionID" FROM tx
WHERE concat('0x', substr(md5(concat('42:', "TransactionID")), 1, 8))::BIGINT % 1000000 < 10000"""
        ),
        "card_max_scores": _with(
            _TRANSACTIONS,
            _MISSING_CARDS,
            body="""
SELECT card1, max("V317") AS max_score, max("isFraud") AS max_label FROM tm GROUP BY card1""",
        ),
        "top_k_cards": _with(
            _TRANSACTIONS,
            _VALID,
            _top("V317"),
            body="SELECT card1, max_score, max_label, position::INTEGER AS position FROM top",
        ),
        "precision_at_k": _with(
            _TRANSACTIONS,
            _VALID,
            _top("V317"),
            body="""
SELECT count(*) AS cards, sum(max_label)::BIGINT AS frauds,
       sum(max_label)::DOUBLE / 50 AS precision FROM top""",
        ),
        "bootstrap_draws": _with(
            *_BOOTSTRAP,
            body="""
SELECT iteration::INTEGER AS iteration, draw::INTEGER AS draw,
       position::INTEGER AS position, label FROM draws""",
        ),
        "bootstrap_precision": _with(
            *_BOOTSTRAP, body="SELECT iteration::INTEGER AS iteration, precision FROM prec"
        ),
        "bootstrap_summary": _with(
            *_BOOTSTRAP,
            body="""
SELECT count(*) AS iterations, round(avg(precision), 4) AS mean,
       round(stddev_samp(precision), 4) AS std,
       round(avg(precision) - 3 * stddev_samp(precision), 4) AS low,
       round(avg(precision) + 3 * stddev_samp(precision), 4) AS high
FROM prec""",
        ),
        "label_index": _prep(labels),
        "one_hot_array": _prep(
            f'SELECT "TransactionID", {one_hot_columns} FROM prep {one_hot_joins}', *_ONE_HOT
        ),
        "minmax_scale": _prep(
            f'SELECT "TransactionID", {_names(DISCRETE_FEATURES)}, {_MIN_MAX} FROM prep'
        ),
        "folded_min_max_scale": _prep(
            f'SELECT "TransactionID", {_names(DISCRETE_FEATURES)}, {_MIN_MAX} FROM prep'
        ),
        "folded_limits": _tx(
            " UNION ALL ".join(
                f"""
SELECT '{c}' AS feature, count("{c}") AS n, count(*) - count("{c}") AS missing,
       min("{c}")::DOUBLE AS low, max("{c}")::DOUBLE AS high FROM tx"""
                for c in CONTINUOUS_FEATURES
            )
        ),
        "exact_quartiles": _tx(quartiles),
        "cap_thresholds": _tx(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS feature, round(quantile_cont("{c}", 0.99), 9) AS p99,
        CASE WHEN {_far(c)} THEN round(quantile_cont("{c}", 0.99), 9) END AS cap FROM tx"""
                for c in CONTINUOUS_FEATURES
            )
        ),
        "learned_caps": _tx(
            'SELECT "TransactionID", '
            + ", ".join(
                f"""CASE WHEN far."{c}" AND tx."{c}" > p."{c}" THEN round(p."{c}", 9)
                    ELSE round(tx."{c}", 9) END AS "{c}" """
                for c in CONTINUOUS_FEATURES
            )
            + " FROM tx, (SELECT "
            + ", ".join(f'{_far(c)} AS "{c}"' for c in CONTINUOUS_FEATURES)
            + " FROM tx) AS far, (SELECT "
            + ", ".join(f'quantile_cont("{c}", 0.99) AS "{c}"' for c in CONTINUOUS_FEATURES)
            + " FROM tx) AS p"
        ),
        "chi_square_selection": _CHI_SQUARE_SELECTION,
        "poisson_bootstrap": _POISSON_BOOTSTRAP,
        "auc_covariance": _AUC_COVARIANCE,
        "chi_square_table": _tx(
            " UNION ALL ".join(
                f"""
SELECT '{c}' AS feature, count(*) AS categories, count(*) - 1 AS dof,
       round(sum(pow(p - n * share, 2) / (n * share)
                 + pow(n - p - n * (1 - share), 2) / (n * (1 - share))), 6) AS chi_square
FROM (SELECT "{c}", sum("isFraud") AS p, count(*) AS n FROM tx GROUP BY "{c}"),
     (SELECT avg("isFraud") AS share FROM tx)"""
                for c in BINARY_FEATURES
            )
        ),
        "correlation_pairs": _tx(
            " UNION ALL ".join(
                f"""
SELECT '{a}' AS first, '{b}' AS second, round(corr("{a}", "{b}"), 6) AS correlation FROM tx"""
                for a, b in combinations(CONTINUOUS_FEATURES, 2)
            )
        ),
        "robust_scale_exact": _prep(
            f'SELECT "TransactionID", {_ROBUST} FROM prep, spread', _SPREADS
        ),
        "feature_array": _FEATURE_ARRAY,
        "discrete_vectors": discrete,
        "saved_pipeline": discrete,
        "roc_auc_exact": _with(_TRANSACTIONS, _AUC, body="SELECT * FROM auc"),
        "roc_auc_evaluator": _with(
            _TRANSACTIONS, _AUC, body="SELECT round(auc, 9) AS auc FROM auc"
        ),
        "pooled_t_statistic": _with(
            _TRANSACTIONS,
            _VALID,
            _top("V280", "top_a"),
            _top("V317", "top_b"),
            _draws("top_a", "draws_a"),
            _draws("top_b", "draws_b"),
            _precision("draws_a", "a"),
            _precision("draws_b", "b"),
            body="""
SELECT n1, n2, n1 + n2 - 2 AS dof,
       round(mean1, 9) AS mean1, round(mean2, 9) AS mean2,
       round(var1, 9) AS var1, round(var2, 9) AS var2,
       round((mean1 - mean2) / sqrt(
         ((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 9) AS t
FROM (SELECT count(*) AS n1, avg(precision) AS mean1, var_samp(precision) AS var1 FROM a),
     (SELECT count(*) AS n2, avg(precision) AS mean2, var_samp(precision) AS var2 FROM b)""",
        ),
        "decisions_on_amounts": _with(
            _TRANSACTIONS,
            _VALID,
            _top("V280", "top_a"),
            _top("V317", "top_b"),
            _draws("top_a", "draws_a"),
            _draws("top_b", "draws_b"),
            _precision("draws_a", "a"),
            _precision("draws_b", "b"),
            # with 198 degrees of freedom p < 0.01 is t < -2.3453
            body="""
SELECT champion, challenger, sign * t < -2.3453 AS replaced
FROM (SELECT (mean1 - mean2) / sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)
                                    * (1.0 / n1 + 1.0 / n2)) AS t
      FROM (SELECT count(*) AS n1, avg(precision) AS mean1, var_samp(precision) AS var1 FROM a),
           (SELECT count(*) AS n2, avg(precision) AS mean2, var_samp(precision) AS var2 FROM b)),
     (VALUES ('V280', 'V317', 1), ('V317', 'V280', -1)) AS cases(champion, challenger, sign)""",
        ),
        "feature_vectors": _tx(
            """
SELECT "TransactionID", 20::INTEGER AS slots, TRUE AS continuous_agree,
       TRUE AS ranges_within_error FROM tx"""
        ),
        "gbt_scores": _with(
            _TRANSACTIONS,
            _VALID,
            body='SELECT "TransactionID", card1, TRUE AS equals_trees FROM valid',
        ),
        "tuning_results": """
SELECT max_depth::INTEGER AS max_depth, min_instances::INTEGER AS min_instances,
       TRUE AS auc_in_range, 1::BIGINT AS best_points, TRUE AS best_is_highest
FROM (VALUES (5), (10), (15)) AS d(max_depth), (VALUES (15), (100), (200)) AS m(min_instances)""",
        "run_log": _tx(
            f"""
SELECT 'experiment' AS kind, 'name' AS key, 'label-counts' AS value
UNION ALL SELECT 'param', 'cutoff', '{_CUTOFF}'
UNION ALL SELECT 'metric', concat('rows_', "isFraud"), count(*)::VARCHAR FROM tx GROUP BY "isFraud" """
        ),
        "envelope_roundtrip": _with(
            _TRANSACTIONS,
            _MISSING_CARDS,
            body=f"SELECT '{_STAMP}' AS ts, card1 AS card_id, {_names(_SCORING_NAMES)} FROM tm",
        ),
        "rejected_messages": _tx(
            """
SELECT CASE "TransactionID" % 12 WHEN 0 THEN 'bad_envelope' WHEN 1 THEN 'no_features'
            WHEN 2 THEN 'bad_features' WHEN 3 THEN 'bad_value' WHEN 4 THEN 'bad_value'
            WHEN 5 THEN 'several_rows' WHEN 6 THEN 'missing_id' WHEN 8 THEN 'no_row'
            ELSE 'ok' END AS reason,
       count(*) AS n
FROM tx GROUP BY 1"""
        ),
        "replay_messages": _tx(
            f"""
SELECT "TransactionID", card1 AS card_id, card1, '{_STAMP}' AS ts FROM tx
ORDER BY concat('0x', substr(md5(concat('42:', "TransactionID")), 1, 8))::BIGINT, "TransactionID"
LIMIT 10"""
        ),
        "result_message_contents": _with(
            _TRANSACTIONS,
            _MISSING_CARDS,
            body="""
SELECT card1::VARCHAR AS key, card1 AS card_id, "TransactionID", card1,
       ("TransactionID" % 101)::DOUBLE / 101 AS probability_
FROM tm""",
        ),
        "results_once": _tx(
            """
SELECT card1::VARCHAR AS key, card1 AS card_id, "TransactionID", card1,
       ("TransactionID" % 101)::DOUBLE / 101 AS probability_,
       concat('transactions/', "TransactionID" % 3, '/', "TransactionID" // 3) AS origin
FROM tx"""
        ),
        "stream_feature_rows": _prep(
            f"""
SELECT '{_STAMP}' AS ts, card1 AS card_id, * EXCLUDE ("isFraud") FROM prep"""
        ),
        "stream_scores": _tx(
            """
SELECT "TransactionID", card1, card1 AS card_id, TRUE AS equals_batch_score FROM tx"""
        ),
        "stream_ingest": _SENSORS.strip(),
        "ingest_rejects": """
SELECT CASE WHEN event_id % 6 < 2 THEN 'reject' ELSE 'row' END AS outcome,
       CASE event_id % 6 WHEN 0 THEN concat('x', event_id, ',a,1.0')
            WHEN 1 THEN concat(event_id, ',b,2.0,3.0') ELSE event_id::VARCHAR END AS line
FROM events""",
    }
