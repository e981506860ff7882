"""Training and tuning of the classifier.

Feature stages do not depend on the tuned parameters. They are fitted once per
training set and the assembled vectors are kept, so a grid of n points costs n
classifier fits instead of n whole pipelines.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame

from riskweave import schema as S
from riskweave.operators.evaluation import auc_evaluator
from riskweave.operators.split import hash_split
from riskweave.plans.pipelines import (
    FEATURES,
    get_feature_extraction_pipeline,
    get_fraud_detection_model_pipeline,
    gradient_boosted_trees,
)
from riskweave.plans.trials import TrialStore, data_digest, trial_key
from riskweave.sources.runlog import RunLog
from riskweave.sources.tables import laid_out, spread
from riskweave.sources.workspace import checkpoint_root, settle

# The searched grid.
GRID_DEPTHS = (5, 10, 15)
GRID_MIN_INSTANCES = (15, 100, 200)

# Fixed value: rows of a task of a fit at most. A task reads some 440 bytes a row, from
# several caches; each task more sends statistics of all nodes, and reads the tree so far.
MOST_ROWS_PER_TASK = 1_000_000
# Fixed value: up to so many vectors are checkpointed. A fit has thousands of stages, and
# each sends the plan of the vectors along; for few rows that takes longer than the rows.
FEW_ROWS = 1_000_000

ParamMap = dict[Param, object]


def parameter_grid(
    classifier: GBTClassifier,
    depths: Sequence[int] = GRID_DEPTHS,
    min_instances: Sequence[int] = GRID_MIN_INSTANCES,
) -> list[ParamMap]:
    return (
        ParamGridBuilder()
        .addGrid(classifier.maxDepth, list(depths))
        .addGrid(classifier.minInstancesPerNode, list(min_instances))
        .build()
    )


def needed_columns(data: DataFrame) -> DataFrame:
    """Only what fitting reads, so that scans prune the rest."""
    keep = [S.TIME, S.LABEL, *S.RAW_FEATURES]
    return data.select(*[c for c in data.columns if c in keep])


def fit_features(data: DataFrame, pipeline: Pipeline | None = None) -> PipelineModel:
    """The fitted feature pipeline: one column-pruned scan per fitted stage.

    Keeping the rows for the later scans costs more than the scans.
    """
    return (pipeline or get_feature_extraction_pipeline()).fit(needed_columns(data))


def feature_vectors(
    data: DataFrame,
    features: PipelineModel,
    partitions: int | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Vectors and labels, kept until unpersisted: a tree fit reads them many times.

    They are dealt out evenly, by default over partitions for the number of rows. The
    scan's own partitions say nothing of it: a filter may leave all rows in a few of them,
    and so may a file with few row groups. ``at_once`` fits share the cores, so each
    has fewer tasks.
    """
    vectors = features.transform(needed_columns(data)).select(FEATURES, S.LABEL)
    rows = data.count()
    if partitions is None:
        dealt = spread(vectors, rows, MOST_ROWS_PER_TASK, at_once)
    else:
        dealt = laid_out(vectors, partitions)
    if rows <= FEW_ROWS:
        dealt = settle(dealt)
    return dealt.persist(StorageLevel.MEMORY_AND_DISK)


def fit_model(
    data: DataFrame,
    classifier: GBTClassifier,
    pipeline: Pipeline | None = None,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit the feature stages, then the classifier on their vectors."""
    checkpoint_root(data.sparkSession)  # tree training cuts its lineage there
    features = fit_features(data, pipeline)
    vectors = feature_vectors(data, features, partitions)
    try:
        return PipelineModel(stages=[*features.stages, classifier.fit(vectors)])
    finally:
        vectors.unpersist()


@dataclass(frozen=True)
class Trial:
    max_depth: int
    min_instances: int
    auc: float
    share: float = 1.0  # of the training rows


@dataclass(frozen=True)
class TuningResult:
    model: PipelineModel
    trials: list[Trial]
    best: Trial

    def best_parameters(self) -> dict[str, int]:
        trees = self.model.stages[-1]
        return {
            "maxDepth": trees.getMaxDepth(),
            "minInstancesPerNode": trees.getMinInstancesPerNode(),
        }

    def explained(self) -> list[str]:
        trees = self.model.stages[-1]
        return [trees.explainParam(name) for name in self.best_parameters()]


def _parameters(classifier: GBTClassifier, point: ParamMap) -> dict[str, object]:
    """Every parameter a fit would use, by name."""
    return {p.name: v for p, v in classifier.extractParamMap(point).items()}


def tune(
    data: DataFrame,
    classifier: GBTClassifier | None = None,
    grid: Sequence[ParamMap] | None = None,
    train_fraction: float = 0.8,
    seed: int = 42,
    parallelism: int = 2,
    partitions: int | None = None,
    trials_path: str | None = None,
    shares: Sequence[float] = (1.0,),
    keep: float = 0.5,
) -> TuningResult:
    """Grid search on one hash split; the best point is refitted on all rows.

    Each trial's AUC is measured on the rows held out from it. The first of
    equally good points wins.

    With ``trials_path`` finished trials are kept there, and a search that was ended
    goes on with those it lacks. By default every point is fitted on all training rows.
    Several rising ``shares`` halve the field instead: all points are fitted on the first
    share of the training rows, and the best ``keep`` of them, at least one, go on to
    the next; what is left after the last share, which must be 1, decides. The shares
    are hash draws, each within the next.
    """
    if list(shares) != sorted(set(shares)) or not shares or shares[0] <= 0 or shares[-1] != 1:
        raise ValueError("shares must rise to 1")
    if not 0 < keep <= 1:
        raise ValueError("keep must be above 0 and at most 1")
    classifier = classifier or gradient_boosted_trees()
    grid = list(grid if grid is not None else parameter_grid(classifier))
    if not grid:
        raise ValueError("no points to try")
    train, held_out = hash_split(data, train_fraction, seed)
    spark = data.sparkSession
    checkpoint_root(spark)
    evaluator = auc_evaluator(bins=0)
    store, known, digest = None, {}, ""
    if trials_path is not None:
        store = TrialStore(spark, trials_path)
        known = store.known()
        read = [S.TRANSACTION_ID, *needed_columns(data).columns]
        digest = f"{data_digest(data.select(*read))}:{train_fraction}:{seed}:{partitions}"

    def run(points: list[int], share: float) -> dict[int, Trial]:
        told = {i: _parameters(classifier, grid[i]) for i in points}
        keys = {i: trial_key(digest, share, told[i]) for i in points}
        open_points = [i for i in points if keys[i] not in known]
        aucs = {i: known[keys[i]] for i in points if keys[i] in known}
        if open_points:
            part = train if share == 1 else hash_split(train, share, seed + 1)[0]
            features = fit_features(part)
            at_once = min(parallelism, len(open_points))
            fitted_on = feature_vectors(part, features, partitions, at_once)
            scored_on = feature_vectors(held_out, features, partitions, at_once)

            def trial(i: int) -> float:
                model = classifier.fit(fitted_on, grid[i])
                auc = evaluator.evaluate(model.transform(scored_on))
                if store is not None:
                    store.record(keys[i], told[i], share, auc)
                return auc

            try:
                # The deepest first, so that no long fit is left to run alone at the end.
                longest = sorted(open_points, key=lambda i: (-told[i]["maxDepth"], i))
                with ThreadPoolExecutor(parallelism) as pool:
                    aucs |= zip(longest, pool.map(trial, longest), strict=True)
            finally:
                fitted_on.unpersist()
                scored_on.unpersist()
        return {
            i: Trial(told[i]["maxDepth"], told[i]["minInstancesPerNode"], aucs[i], share)
            for i in points
        }

    points, trials = list(range(len(grid))), []
    for share in shares:
        found = run(points, share)
        trials += found.values()
        ranked = sorted(points, key=lambda i: (-found[i].auc, i))
        points = sorted(ranked[: max(1, math.ceil(len(ranked) * keep))])

    winner = ranked[0]
    model = fit_model(data, classifier.copy(grid[winner]), partitions=partitions)
    return TuningResult(model, trials, found[winner])


def random_split_tuner(
    pipeline: Pipeline | None = None,
    grid: Sequence[ParamMap] | None = None,
    train_fraction: float = 0.8,
    seed: int = 42,
    parallelism: int = 2,
) -> TrainValidationSplit:
    """Spark's own tuner over the whole pipeline; its split depends on partitioning."""
    pipeline = pipeline or get_fraud_detection_model_pipeline()
    return TrainValidationSplit(
        estimator=pipeline,
        estimatorParamMaps=list(grid or parameter_grid(pipeline.getStages()[-1])),
        evaluator=auc_evaluator(),
        trainRatio=train_fraction,
        parallelism=parallelism,
        seed=seed,
    )


def log_tuning(result: TuningResult, data: DataFrame, log: RunLog) -> None:
    """Best parameters, AUC on the held-out rows and AUC on all rows.

    The all-rows figure includes training rows and is optimistic.
    """
    log.params(result.best_parameters())
    everything = auc_evaluator(bins=0).evaluate(result.model.transform(data))
    log.metrics({"roc_auc_held_out": result.best.auc, "roc_auc": everything})
