"""Named queries, each ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions import messages as M
from riskweave.functions.expressions import positive_probability
from riskweave.operators import (
    encoding,
    evaluation,
    features,
    fit_states,
    quantiles,
    ranking,
    selection,
    split,
    transformers,
)
from riskweave.operators.joins import ROWS_PER_TASK, BroadcastBound
from riskweave.plans import pipelines, training
from riskweave.plans.champion import decide, run_champion_challenger
from riskweave.sources import bucketed, commits, tables
from riskweave.sources.events import (
    WEEK_CUTOFF,
    read_event_transactions,
    read_events,
    transactions_from_events,
)
from riskweave.sources.runlog import RunLog, read_run_log
from riskweave.sources.workspace import scratch_path, settle
from riskweave.streaming import ingest, publishing, replay, scoring

Query = Callable[[SparkSession, str], DataFrame]

K = 50
STAMP = "2024-02-01T00:00:00.000000"
MOST_MESSAGES_PER_TASK = 250_000

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_transactions(spark, sf_dir)


def _with_missing_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = F.when(F.col(S.TRANSACTION_ID) % 31 != 0, F.col(S.CARD))
    return _transactions(spark, sf_dir).withColumn(S.CARD, card)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prepare_features(_transactions(spark, sf_dir))


def _top_cards(spark: SparkSession, sf_dir: str, score: str = "V317", k: int = K) -> DataFrame:
    """Riskiest validation cards by their highest value of one raw column."""
    data = _transactions(spark, sf_dir).select(
        S.TRANSACTION_ID, S.TIME, S.CARD, S.LABEL, F.col(score).alias("prob_flag")
    )
    _, valid = split.train_validation_split(data, WEEK_CUTOFF)
    return ranking.top_k_cards(ranking.card_max_scores(valid), k)


# Scans, sources and sinks


@_query
def transactions_scan(spark, sf_dir):
    return _transactions(spark, sf_dir)


@_query
def row_count(spark, sf_dir):
    return _transactions(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def _month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read_parquet(spark, f"{sf_dir}/orders.parquet")
    months = orders.select(F.month("o_orderdate").alias("Month"))
    return months.groupBy("Month").agg(F.count(F.lit(1)).alias("n"))


@_query
def group_count_by_month(spark, sf_dir):
    return _month_counts(spark, sf_dir)


@_query
def month_counts_csv(spark, sf_dir):
    path = scratch_path(spark, "month-counts")
    tables.write_csv(_month_counts(spark, sf_dir), path)
    return spark.read.schema("Month int, n bigint").csv(path, header=True)


@_query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "transactions-parquet")
    days = _transactions(spark, sf_dir).withColumn("day", F.floor(F.col(S.TIME) / 86400))
    tables.write_parquet(days, path, partition_by=["day"])
    return tables.read_transactions(spark, path).select(S.TRANSACTION_SCHEMA.names)


@_query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "transactions-csv")
    tables.write_csv(_transactions(spark, sf_dir), path)
    return tables.read_csv(spark, f"{path}/*.csv", S.TRANSACTION_SCHEMA)


@_query
def catalog_table(spark, sf_dir):
    path = scratch_path(spark, "transactions-table")
    name = "transactions_" + path.rsplit("-", 1)[-1]
    _transactions(spark, sf_dir).write.option("path", path).saveAsTable(name)
    rows = tables.read_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return rows


@_query
def repartitioned_output(spark, sf_dir):
    path = scratch_path(spark, "repartitioned")
    data = _transactions(spark, sf_dir).select(S.TRANSACTION_ID, S.CARD)
    tables.write_parquet(data, path, partitions=4)
    return tables.read_parquet(spark, path)


# Row-wise features


@_query
def binarize(spark, sf_dir):
    data = features.binarize(_transactions(spark, sf_dir), S.BINARY_FEATURES)
    return data.select(S.TRANSACTION_ID, *S.BINARY_FEATURES)


@_query
def cap_outliers(spark, sf_dir):
    data = features.cap_outliers(_transactions(spark, sf_dir), S.CAP_THRESHOLDS)
    return data.select(S.TRANSACTION_ID, *S.CONTINUOUS_FEATURES)


@_query
def time_parts(spark, sf_dir):
    data = features.add_time_parts(_transactions(spark, sf_dir))
    return data.select(S.TRANSACTION_ID, "weekdays", "hours", "minutes")


@_query
def fill_nulls(spark, sf_dir):
    outputs = [f"{c}_filled" for c in S.CONTINUOUS_FEATURES]
    data = features.fill_missing(
        _transactions(spark, sf_dir), S.CONTINUOUS_FILLER, S.CONTINUOUS_FEATURES, outputs
    )
    return data.select(S.TRANSACTION_ID, *outputs)


@_query
def discrete_to_string(spark, sf_dir):
    texts = [features.text_column(c) for c in S.BINARY_FEATURES]
    data = features.discrete_to_text(_transactions(spark, sf_dir), S.BINARY_FEATURES, texts)
    return data.select(S.TRANSACTION_ID, *texts)


@_query
def feature_prep_chain(spark, sf_dir):
    return _prepared(spark, sf_dir)


# Filters, splits and anti joins


@_query
def fraud_transactions(spark, sf_dir):
    data = _transactions(spark, sf_dir).where(F.col(S.LABEL) == 1)
    return data.select(S.TRANSACTION_ID, S.CARD, S.LABEL)


@_query
def temporal_split_train(spark, sf_dir):
    return split.training_rows(_transactions(spark, sf_dir), WEEK_CUTOFF)


@_query
def compromised_cards(spark, sf_dir):
    return split.compromised_cards(
        split.training_rows(_transactions(spark, sf_dir), WEEK_CUTOFF)
    )


@_query
def temporal_split_valid(spark, sf_dir):
    return split.train_validation_split(_transactions(spark, sf_dir), WEEK_CUTOFF)[1]


@_query
def split_with_missing_cards(spark, sf_dir):
    return split.train_validation_split(_with_missing_cards(spark, sf_dir), WEEK_CUTOFF)[1]


@_query
def split_without_frauds(spark, sf_dir):
    """Nothing is compromised before second 0, so even rows without a card stay."""
    return split.train_validation_split(_with_missing_cards(spark, sf_dir), 0)[1]


def _bucketed_validation(spark: SparkSession, sf_dir: str, rows_per_task: int) -> DataFrame:
    path = scratch_path(spark, "cards-bucketed")
    name = "cards_" + path.rsplit("-", 1)[-1]
    rows = _with_missing_cards(spark, sf_dir).select(
        S.TRANSACTION_ID, S.TIME, S.CARD, S.LABEL, "V317"
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = bucketed.write_bucketed(rows, name, path, S.CARD, buckets, rows_per_task)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    bad = stored.per_part(lambda p: split.compromised_cards(split.training_rows(p, WEEK_CUTOFF)))
    later = stored.per_part(lambda p: p.where(F.col(S.TIME) >= WEEK_CUTOFF))
    valid = later.excluding(bad, "not_in")
    return valid.per_part(lambda p: ranking.card_max_scores(p, "V317")).rows()


@_query
def bucketed_card_scores(spark, sf_dir):
    """Split and maxima per card over a table in buckets of cards."""
    return _bucketed_validation(spark, sf_dir, ROWS_PER_TASK)


@_query
def bucketed_hot_card_scores(spark, sf_dir):
    """The same where most cards count as hot and are stored beside the buckets."""
    return _bucketed_validation(spark, sf_dir, 80)


def _sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    device = F.when(F.col("event_id") % 31 != 0, F.col("user_id"))
    return read_events(spark, sf_dir).select(
        device.alias("device_id"), F.col("ts").cast("string").alias("ts"), "value"
    )


@_query
def denylist_anti_join(spark, sf_dir):
    readings = _sensor_readings(spark, sf_dir)
    denied = readings.where(F.col("value") > 250).select("device_id")
    return split.without_denied(readings, denied).select("device_id", "value")


_SHUFFLED = BroadcastBound(rows=0)  # as if the key set were too large to broadcast


@_query
def split_beyond_broadcast(spark, sf_dir):
    """Rows whose card a Bloom filter rules out stay in place, the others are joined."""
    data = _with_missing_cards(spark, sf_dir)
    return split.train_validation_split(data, WEEK_CUTOFF, _SHUFFLED)[1]


@_query
def denylist_beyond_broadcast(spark, sf_dir):
    readings = _sensor_readings(spark, sf_dir)
    denied = readings.where(F.col("value") > 250).select("device_id")
    left = split.without_denied(readings, denied, bound=_SHUFFLED, salt_by=["ts", "value"])
    return left.select("device_id", "value")


@_query
def hash_split(spark, sf_dir):
    drawn = split.hash_parts(_transactions(spark, sf_dir))
    part = F.when(F.col("in_first"), "train").otherwise("held_out")
    return drawn.select(S.TRANSACTION_ID, part.alias("part"))


@_query
def hash_sample(spark, sf_dir):
    return split.hash_sample(_transactions(spark, sf_dir), 0.01).select(S.TRANSACTION_ID)


# Card ranking


@_query
def card_max_scores(spark, sf_dir):
    data = _with_missing_cards(spark, sf_dir)
    return ranking.card_max_scores(data, score="V317")


@_query
def top_k_cards(spark, sf_dir):
    return _top_cards(spark, sf_dir)


@_query
def precision_at_k(spark, sf_dir):
    return ranking.precision_at_k(_top_cards(spark, sf_dir), K)


@_query
def bootstrap_draws(spark, sf_dir):
    return ranking.bootstrap_draws(_top_cards(spark, sf_dir))


@_query
def bootstrap_precision(spark, sf_dir):
    return ranking.bootstrap_precision(_top_cards(spark, sf_dir), K)


@_query
def bootstrap_summary(spark, sf_dir):
    scores = ranking.bootstrap_precision(_top_cards(spark, sf_dir), K)
    summary = ranking.bootstrap_summary(scores)
    return summary.select(
        "iterations", *[F.round(c, 4).alias(c) for c in ("mean", "std", "low", "high")]
    )


def _valid_cards(spark: SparkSession, sf_dir: str, score: str = "V317") -> DataFrame:
    """All validation cards with their highest value of one raw column."""
    data = _transactions(spark, sf_dir).select(
        S.TRANSACTION_ID, S.TIME, S.CARD, S.LABEL, F.col(score).alias("prob_flag")
    )
    return ranking.card_max_scores(split.train_validation_split(data, WEEK_CUTOFF)[1])


@_query
def poisson_bootstrap(spark, sf_dir):
    """Every resample of all cards chooses its own top cards."""
    return ranking.poisson_bootstrap_precision(_valid_cards(spark, sf_dir), K)


# Indexing, encoding and scaling


@_query
def label_index(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    parts = [
        encoding.label_index(prepared, features.text_column(c)).select(
            F.lit(c).alias("feature"), "label", "n", "index"
        )
        for c in S.BINARY_FEATURES
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def one_hot_array(spark, sf_dir):
    prepared = _prepared(spark, sf_dir).select(
        S.TRANSACTION_ID, *[features.text_column(c) for c in S.BINARY_FEATURES]
    )
    coded = prepared
    for c in S.BINARY_FEATURES:
        text = features.text_column(c)
        coded = encoding.one_hot(coded, text, f"onehot_{c}", prepared, [S.TRANSACTION_ID])
    return coded.select(
        S.TRANSACTION_ID,
        *[
            F.array_join(
                encoding.dense(F.col(f"onehot_{c}")).cast("array<string>"), ""
            ).alias(f"onehot_{c}")
            for c in S.BINARY_FEATURES
        ],
    )


@_query
def minmax_scale(spark, sf_dir):
    prepared = _prepared(spark, sf_dir).select(S.TRANSACTION_ID, *S.DISCRETE_FEATURES)
    return encoding.min_max_scale(prepared, S.DISCRETE_FEATURES)


def _weekly_states(spark: SparkSession, rows: DataFrame, columns: list[str]) -> DataFrame:
    """States of each week, committed one by one, folded; the last week comes twice."""
    path = scratch_path(spark, "fit-states")
    week = F.floor(F.col(S.TIME) / WEEK_CUTOFF)
    weeks = sorted(r[0] for r in rows.select(week).distinct().collect())
    for part in [*weeks, *weeks[-1:]]:
        fit_states.add_part(rows.where(week == part), columns, path, part)
    return fit_states.folded(spark, path)


@_query
def folded_min_max_scale(spark, sf_dir):
    """Scaled by limits that were folded from weekly states."""
    prepared = _prepared(spark, sf_dir).select(S.TRANSACTION_ID, S.TIME, *S.DISCRETE_FEATURES)
    state = _weekly_states(spark, prepared, S.DISCRETE_FEATURES)
    limits = fit_states.min_max_of(state)
    scaled = {
        f"{c}_scaled": encoding.min_max_scaled(F.col(c), *limits[c]) for c in S.DISCRETE_FEATURES
    }
    return prepared.drop(S.TIME).withColumns(scaled)


@_query
def folded_limits(spark, sf_dir):
    """Counts and limits of raw columns, NULLs apart, folded from weekly states."""
    names = list(S.CONTINUOUS_FEATURES)
    rows = _transactions(spark, sf_dir).select(S.TIME, *names)
    return fit_states.counts_and_limits(_weekly_states(spark, rows, names))


@_query
def exact_quartiles(spark, sf_dir):
    names = S.CONTINUOUS_FEATURES
    found = quantiles.exact_quantiles(_transactions(spark, sf_dir), names, [0.25, 0.5, 0.75])
    rows = [(c, *found[c]) for c in names]
    return spark.createDataFrame(rows, "feature string, q25 double, q50 double, q75 double")


@_query
def robust_scale_exact(spark, sf_dir):
    prepared = _prepared(spark, sf_dir).select(S.TRANSACTION_ID, *S.CONTINUOUS_FEATURES)
    scaled = encoding.robust_scale(prepared, S.CONTINUOUS_FEATURES)
    return scaled.select(S.TRANSACTION_ID, *[f"{c}_scaled" for c in S.CONTINUOUS_FEATURES])


@_query
def feature_array(spark, sf_dir):
    parts = encoding.feature_arrays(_transactions(spark, sf_dir))
    vectors = encoding.as_feature_array(parts)
    return vectors.select(
        S.TRANSACTION_ID, F.posexplode("features").alias("slot", "value")
    )


@_query
def feature_vectors(spark, sf_dir):
    """Whether each continuous slot is the prepared value over the fitted range, and whether
    these ranges are within the scaler's rank error; ``discrete_vectors`` has the rest."""
    data = _transactions(spark, sf_dir)
    model = training.fit_features(data)
    ranges = model.stages[11].range
    names, rank_error = S.CONTINUOUS_FEATURES, 0.002
    ends = [p + e for p in (0.25, 0.75) for e in (-rank_error, rank_error)]
    found = quantiles.exact_quantiles(_prepared(spark, sf_dir), names, ends)
    within = all(
        low[2] - low[1] - 1e-9 <= width <= low[3] - low[0] + 1e-9
        for low, width in zip((found[c] for c in names), ranges, strict=True)
    )
    slots = vector_to_array("features")
    first = 20 - len(names)
    agrees = F.lit(True)
    for i, c in enumerate(names):
        expected = F.col(c) / float(ranges[i]) if ranges[i] else F.lit(0.0)
        agrees &= F.abs(F.get(slots, first + i) - expected) < 1e-9
    return model.transform(data).select(
        S.TRANSACTION_ID,
        F.size(slots).alias("slots"),
        agrees.alias("continuous_agree"),
        F.lit(within).alias("ranges_within_error"),
    )


def _discrete_parts(vectors: DataFrame) -> DataFrame:
    """The parts of the ML feature vector that are exact: one-hot and min-max."""
    scaled = vector_to_array("discrete_vector_scaled")

    def bits(column: str):
        return F.array_join(vector_to_array(column).cast("array<int>").cast("array<string>"), "")

    return vectors.select(
        S.TRANSACTION_ID,
        *[bits(f"{c}_encoded").alias(f"onehot_{c}") for c in S.BINARY_FEATURES],
        *[F.get(scaled, i).alias(f"{c}_scaled") for i, c in enumerate(S.DISCRETE_FEATURES)],
    )


@_query
def discrete_vectors(spark, sf_dir):
    data = _transactions(spark, sf_dir)
    return _discrete_parts(training.fit_features(data).transform(data))


@_query
def saved_pipeline(spark, sf_dir):
    """Saved, loaded and applied."""
    data = _transactions(spark, sf_dir)
    path = scratch_path(spark, "feature-pipeline")
    tables.save_model(training.fit_features(data), path)
    return _discrete_parts(tables.load_model(path).transform(data))


# Caps and selection


@_query
def cap_thresholds(spark, sf_dir):
    """The 0.99 quantile of each column, and a cap where the maximum is far beyond it."""
    found = selection.tails(_transactions(spark, sf_dir), S.CONTINUOUS_FEATURES)
    caps = [(c, t.quantile, t.quantile if t.is_far else None) for c, t in found.items()]
    rows = spark.createDataFrame(caps, "feature string, p99 double, cap double")
    return rows.select("feature", F.round("p99", 9).alias("p99"), F.round("cap", 9).alias("cap"))


@_query
def learned_caps(spark, sf_dir):
    """Caps learned by the fitted stage of a pipeline, saved, loaded and applied."""
    data = _transactions(spark, sf_dir)
    path = scratch_path(spark, "learned-caps")
    stages = [transformers.OutlierCapEstimator(inputCols=S.CONTINUOUS_FEATURES)]
    tables.save_model(Pipeline(stages=stages).fit(data), path)
    capped = tables.load_model(path).transform(data)
    return capped.select(S.TRANSACTION_ID, *[F.round(c, 9).alias(c) for c in S.CONTINUOUS_FEATURES])


@_query
def chi_square_table(spark, sf_dir):
    table = selection.chi_square_table(_transactions(spark, sf_dir), S.BINARY_FEATURES)
    return table.withColumn("chi_square", F.round("chi_square", 6))


@_query
def chi_square_selection(spark, sf_dir):
    """Features that depend on the label, among two binary ones and two of time."""
    data = features.add_time_parts(_transactions(spark, sf_dir))
    table = selection.chi_square_selection(data, [*S.BINARY_FEATURES, "weekdays", "hours"])
    rounded = [F.round(c, 6).alias(c) for c in ("chi_square", "p_value")]
    return table.select("feature", "categories", "dof", *rounded, "selected")


@_query
def correlation_pairs(spark, sf_dir):
    pairs = selection.correlation_pairs(_transactions(spark, sf_dir), S.CONTINUOUS_FEATURES)
    return pairs.withColumn("correlation", F.round("correlation", 6))


# Evaluation


def _scored_by_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _transactions(spark, sf_dir)
    return data.select(F.coalesce("V317", F.lit(0.0)).alias("score"), S.LABEL)


@_query
def roc_auc_exact(spark, sf_dir):
    return evaluation.exact_auc(_scored_by_amount(spark, sf_dir), "score")


@_query
def roc_auc_evaluator(spark, sf_dir):
    scored = _scored_by_amount(spark, sf_dir)
    auc = evaluation.auc_evaluator(score="score", bins=0).evaluate(scored)
    return spark.createDataFrame([(auc,)], "auc double").select(F.round("auc", 9).alias("auc"))


@_query
def auc_covariance(spark, sf_dir):
    """The AUC of two raw columns as scores of the same rows, and how they vary together."""
    scores = [F.coalesce(c, F.lit(0.0)).alias(f"score_{c}") for c in ("V280", "V317")]
    scored = _transactions(spark, sf_dir).select(S.LABEL, *scores)
    row = evaluation.auc_covariance(scored, "score_V280", "score_V317")
    rounded = [F.round(c, 9).alias(c) for c in ("auc1", "auc2", "z")]
    variances = [F.round(F.col(c) * 1e6, 6).alias(c) for c in ("var1", "var2", "covariance")]
    return row.select(*rounded, *variances, "positives", "negatives")


@_query
def pooled_t_statistic(spark, sf_dir):
    samples = [
        ranking.bootstrap_precision(_top_cards(spark, sf_dir, score), K)
        for score in ("V280", "V317")
    ]
    result = evaluation.pooled_t_statistic(*samples, "precision")
    rounded = [F.round(c, 9).alias(c) for c in ("mean1", "mean2", "var1", "var2", "t")]
    return result.select("n1", "n2", "dof", *rounded)


@_query
def decisions_on_amounts(spark, sf_dir):
    """The contest's decision with raw columns as scores, once each way round."""
    samples = {
        score: ranking.bootstrap_precision(
            _top_cards(spark, sf_dir, score), K, output=f"precision_top_{K}"
        )
        for score in ("V280", "V317")
    }
    rows = []
    for champion, challenger in (("V280", "V317"), ("V317", "V280")):
        decision = decide(samples[champion], samples[challenger], K)
        rows.append((champion, challenger, decision.replace_champion))
    return spark.createDataFrame(rows, "champion string, challenger string, replaced boolean")


# Models


def _fit_on_first_week(data: DataFrame):
    train = split.training_rows(data, WEEK_CUTOFF)
    trees = pipelines.gradient_boosted_trees()
    return training.fit_model(train, trees)


@_query
def gbt_scores(spark, sf_dir):
    """Validation rows, and whether each score equals that of the trees written as SQL."""
    data = _transactions(spark, sf_dir)
    _, valid = split.train_validation_split(data, WEEK_CUTOFF)
    model = _fit_on_first_week(data)
    probability = positive_probability(F.col("probability"))
    expected = pipelines.probability_of_trees(model.stages[-1], vector_to_array("features"))
    return model.transform(valid).select(
        S.TRANSACTION_ID, S.CARD, (F.abs(probability - expected) < 1e-9).alias("equals_trees")
    )


@_query
def tuning_results(spark, sf_dir):
    data = _transactions(spark, sf_dir)
    result = training.tune(data, parallelism=4)
    trials = [(t.max_depth, t.min_instances, t.auc, t is result.best) for t in result.trials]
    rows = spark.createDataFrame(
        trials, "max_depth int, min_instances int, auc double, best boolean"
    )
    whole = Window.partitionBy()
    highest = F.max(F.when(F.col("best"), F.col("auc"))).over(whole) == F.max("auc").over(whole)
    return rows.select(
        "max_depth",
        "min_instances",
        F.col("auc").between(0.5, 1.0).alias("auc_in_range"),
        F.count_if("best").over(whole).alias("best_points"),
        highest.alias("best_is_highest"),
    )


@_query
def champion_decision(spark, sf_dir):
    data = _transactions(spark, sf_dir)
    log = RunLog(spark, scratch_path(spark, "run-log"), "champion-challenger")
    champion = _fit_on_first_week(data)
    run_champion_challenger(
        data,
        champion,
        cutoff=WEEK_CUTOFF,
        output_path=scratch_path(spark, "challenger"),
        log=log,
    )
    entries = read_run_log(spark, log.path)
    return entries.where(F.col("kind") == "decision").select("key", "value")


@_query
def run_log(spark, sf_dir):
    data = _transactions(spark, sf_dir)
    counts = data.agg(
        *[F.count_if(F.col(S.LABEL) == label).alias(f"rows_{label}") for label in (0, 1)]
    )
    log = RunLog(spark, scratch_path(spark, "run-log"), "label-counts")
    log.params({"cutoff": WEEK_CUTOFF})
    log.metrics(counts.first().asDict())
    return read_run_log(spark, log.path).select("kind", "key", "value")


# Messages and streams


def _messages(data: DataFrame) -> DataFrame:
    return replay.to_messages(data, F.lit(STAMP))


@_query
def envelope_roundtrip(spark, sf_dir):
    messages = _messages(_with_missing_cards(spark, sf_dir))
    return scoring.usable(scoring.parse_messages(messages))


@_query
def rejected_messages(spark, sf_dir):
    """Most messages altered, in ten ways; counted by reason."""
    data = _transactions(spark, sf_dir)
    value, kind = F.col("value"), F.col(S.TRANSACTION_ID) % 12
    head = r'\"TransactionID\":{\"0\":'
    number = F.col(S.TRANSACTION_ID).cast("string")
    cell = F.concat(F.lit(head), number, F.lit("}"))

    def with_cell(*text) -> Column:
        return F.replace(value, cell, F.concat(F.lit(head), *text, F.lit("}")))

    damaged = (
        F.when(kind == 0, F.expr("left(value, length(value) - 5)"))
        .when(kind == 1, F.lit('{"ts": "now", "card_id": 1}'))
        .when(kind == 2, F.lit('{"ts": "now", "card_id": 1, "features": "V26"}'))
        .when(kind == 3, with_cell(F.lit("1e20")))
        .when(kind == 4, with_cell(number, F.lit(".5")))
        .when(kind == 5, with_cell(number, F.lit(r',\"1\":'), number))
        .when(kind == 6, with_cell(F.lit("null")))
        .when(kind == 7, F.replace(value, F.lit(r'{\"0\":'), F.lit(r'{\"row 7\":')))
        .when(kind == 8, F.lit('{"ts": "now", "card_id": 1, "features": "{}"}'))
        .otherwise(value)
    )
    columns = [c for c in data.columns if c != S.LABEL]
    envelope = M.input_envelope(columns, F.col(S.CARD), F.lit(STAMP))
    messages = data.select(S.TRANSACTION_ID, envelope.alias("value")).select(
        damaged.alias("value")
    )
    parsed = scoring.parse_messages(messages)
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


@_query
def replay_messages(spark, sf_dir):
    picked = replay.pick_rows(_transactions(spark, sf_dir), 10)
    parsed = scoring.parse_messages(_messages(picked))
    return parsed.select(S.TRANSACTION_ID, "card_id", S.CARD, "ts")


@_query
def result_message_contents(spark, sf_dir):
    data = _with_missing_cards(spark, sf_dir)
    probability = (F.col(S.TRANSACTION_ID) % 101 / 101).alias("probability_")
    sent = scoring.result_messages(data.select(S.TRANSACTION_ID, S.CARD, probability))
    return _decoded_results(sent)


def _decoded_results(sent: DataFrame, *others: str) -> DataFrame:
    envelope = F.from_json(F.col("value").cast("string"), M.RESULT_ENVELOPE_SCHEMA)
    opened = sent.select(F.col("key").cast("string").alias("key"), envelope.alias("e"), *others)
    result = F.from_json(F.col("e.result"), M.RESULT_SCHEMA)
    card = F.col("e.card_id").alias("card_id")
    return opened.select("key", card, result.alias("r"), *others).select(
        "key", "card_id", "r.*", *others
    )


def _streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream takes one file only through a pattern; a folder of files matches too.
    table = read_events(spark, sf_dir)
    events = spark.readStream.schema(table.schema).parquet(f"{sf_dir}/events.parque[t]")
    # A message is many times as large as its event, and a batch of parsed ones is kept.
    events = tables.spread(events, table.count(), MOST_MESSAGES_PER_TASK)
    return _messages(transactions_from_events(events))


@_query
def stream_feature_rows(spark, sf_dir):
    """Messages parsed and prepared by a stream, written and read back."""
    prepared = features.prepare_features(
        scoring.usable(scoring.parse_messages(_streamed_messages(spark, sf_dir)))
    )
    path = scratch_path(spark, "stream-features")
    query = (
        prepared.writeStream.format("parquet")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read_parquet(spark, f"{path}/rows", prepared.schema)


@_query
def stream_scores(spark, sf_dir):
    """Every message scored by a stream, beside the score of its row in a batch."""
    data = _transactions(spark, sf_dir)
    model = _fit_on_first_week(data)
    path = scratch_path(spark, "stream-scores")
    query = scoring.start_scoring(
        _streamed_messages(spark, sf_dir),
        model,
        commits.commit_batch(f"{path}/results"),
        commits.commit_batch(f"{path}/rejects"),
        f"{path}/checkpoint",
        {"availableNow": True},
    )
    query.awaitTermination()
    sent = commits.read_committed(spark, f"{path}/results", scoring.RESULT_SCHEMA)
    streamed = _decoded_results(sent).select(S.TRANSACTION_ID, S.CARD, "card_id", "probability_")
    batch = scoring.score_rows(data, model).select(
        S.TRANSACTION_ID, F.col("probability_").alias("expected")
    )
    agrees = F.abs(F.col("probability_") - F.col("expected")) < 1e-12
    return streamed.join(batch, S.TRANSACTION_ID, "left").select(
        S.TRANSACTION_ID, S.CARD, "card_id", agrees.alias("equals_batch_score")
    )


@_query
def results_once(spark, sf_dir):
    """Results of all transactions, a third of the batches sent twice, read as a stream."""
    place = {
        "topic": F.lit("transactions"),
        "partition": F.col(S.TRANSACTION_ID) % 3,
        "offset": F.floor(F.col(S.TRANSACTION_ID) / 3),
    }
    envelope = M.input_envelope(S.SCORING_SCHEMA.names, F.col(S.CARD), F.lit(STAMP))
    events = read_events(spark, sf_dir)
    dealt = tables.spread(events, events.count(), ROWS_PER_TASK)  # parsing is the longest step
    received = transactions_from_events(dealt).select(
        envelope.alias("value"), *[column.alias(name) for name, column in place.items()]
    )
    number = F.col(S.TRANSACTION_ID)
    probability = (number % 101 / 101).alias("probability_")
    scored = settle(  # sent twice, parsed once
        scoring.usable(scoring.parse_messages(received)).select(
            S.TRANSACTION_ID, S.CARD, probability, publishing.ORIGIN
        )
    )
    path = scratch_path(spark, "results-once")
    scoring.result_messages(scored).write.parquet(f"{path}/sent")
    again = scored.where(number % 3 == 0)  # as a batch repeated after a failure
    scoring.result_messages(again).write.mode("append").parquet(f"{path}/sent")
    sent = spark.readStream.schema(publishing.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 4)
    once = publishing.first_of_each_origin(sent.parquet(f"{path}/sent"))
    (
        once.writeStream.foreachBatch(commits.commit_batch(f"{path}/results"))
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    stored = commits.read_committed(spark, f"{path}/results", once.schema)
    return _decoded_results(stored, publishing.ORIGIN)


@_query
def stream_ingest(spark, sf_dir):
    path = scratch_path(spark, "stream-ingest")
    tables.write_csv(_sensor_readings(spark, sf_dir), f"{path}/incoming")
    query = ingest.start_csv_ingest(
        spark, f"{path}/incoming", f"{path}/sensors", f"{path}/checkpoint"
    )
    query.awaitTermination()
    return commits.read_committed(spark, f"{path}/sensors", S.SENSOR_SCHEMA)


@_query
def ingest_rejects(spark, sf_dir):
    """Lines of CSV files with readings, a third of them damaged in two ways, by outcome."""
    path = scratch_path(spark, "ingest-rejects")
    number = F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_id") % 6 == 0, F.concat(F.lit("x"), number, F.lit(",a,1.0")))
        .when(F.col("event_id") % 6 == 1, F.concat(number, F.lit(",b,2.0,3.0")))
        .otherwise(F.concat(number, F.lit(",c,"), F.col("value").cast("string")))
    )
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    header = F.lit(",".join(S.SENSOR_SCHEMA.names) + "\n")
    texts = F.when(place == 0, F.concat(header, line)).otherwise(line)  # one file per partition
    read_events(spark, sf_dir).select(texts.alias("value")).write.text(f"{path}/incoming")
    ingest.start_csv_ingest(
        spark,
        f"{path}/incoming",
        f"{path}/sensors",
        f"{path}/checkpoint",
        pattern="*.txt",
        rejects=f"{path}/rejects",
    ).awaitTermination()
    good = commits.read_committed(spark, f"{path}/sensors", S.SENSOR_SCHEMA)
    bad = commits.read_committed(spark, f"{path}/rejects", tables.with_record(S.SENSOR_SCHEMA))
    device = F.col("device_id").cast("string")
    return good.select(F.lit("row").alias("outcome"), device.alias("line")).unionByName(
        bad.select(F.lit("reject").alias("outcome"), F.col(tables.RECORD).alias("line"))
    )
