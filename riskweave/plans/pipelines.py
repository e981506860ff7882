"""The feature pipeline and the model pipelines built on it."""

from __future__ import annotations

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    RobustScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.features import text_column
from riskweave.operators.transformers import (
    ContinuousOutliersCapper,
    DiscreteToBinaryTransformer,
    OutlierCapEstimator,
    ScalarNAFiller,
    StringFromDiscrete,
    TimeFeaturesGenerator,
)

FEATURES = "features"


def _row_wise_stages(learn_caps: bool) -> list[Estimator | Transformer]:
    texts = [text_column(c) for c in S.BINARY_FEATURES]
    discrete = S.BINARY_FEATURES + S.DISCRETE_FEATURES
    return [
        DiscreteToBinaryTransformer(inputCols=S.BINARY_FEATURES, outputCols=S.BINARY_FEATURES),
        OutlierCapEstimator(inputCols=S.CONTINUOUS_FEATURES)
        if learn_caps
        else ContinuousOutliersCapper(
            inputCols=list(S.CAP_THRESHOLDS), maximum=list(S.CAP_THRESHOLDS.values())
        ),
        TimeFeaturesGenerator(inputCols=[S.TIME]),
        ScalarNAFiller(inputCols=discrete, outputCols=discrete, filler=S.DISCRETE_FILLER),
        ScalarNAFiller(
            inputCols=S.CONTINUOUS_FEATURES,
            outputCols=S.CONTINUOUS_FEATURES,
            filler=S.CONTINUOUS_FILLER,
        ),
        StringFromDiscrete(inputCols=S.BINARY_FEATURES, outputCols=texts),
    ]


def _fitted_stages(quantile_error: float) -> list[Estimator | Transformer]:
    # The names of the columns between the stages; feature tables have them.
    texts = [text_column(c) for c in S.BINARY_FEATURES]
    indexes = [f"{c}_index" for c in S.BINARY_FEATURES]
    encoded = [f"{c}_encoded" for c in S.BINARY_FEATURES]
    return [
        StringIndexer(inputCols=texts, outputCols=indexes, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexes, outputCols=encoded),
        VectorAssembler(inputCols=S.DISCRETE_FEATURES, outputCol="discrete_assembled"),
        MinMaxScaler(inputCol="discrete_assembled", outputCol="discrete_vector_scaled"),
        VectorAssembler(inputCols=S.CONTINUOUS_FEATURES, outputCol="continuous_assembled"),
        RobustScaler(
            inputCol="continuous_assembled",
            outputCol="continuous_vector_scaled",
            relativeError=quantile_error,
        ),
        VectorAssembler(
            inputCols=[*encoded, "discrete_vector_scaled", "continuous_vector_scaled"],
            outputCol=FEATURES,
        ),
    ]


def get_feature_extraction_pipeline(
    quantile_error: float = 0.001, learn_caps: bool = False
) -> Pipeline:
    """Raw transactions to the ``features`` vector, in 13 stages.

    Caps are the fixed ones, or, with ``learn_caps``, learned from the training rows.
    """
    return Pipeline(stages=_row_wise_stages(learn_caps) + _fitted_stages(quantile_error))


def gradient_boosted_trees(**params) -> GBTClassifier:
    """Champion settings unless overridden; always seeded.

    Two settings say how a fit runs, not what it finds. The node of a row is looked up in the
    tree: keeping it at each level takes as long as all else of the level. Margins are
    checkpointed after every second tree: tasks carry along all trees since.
    """
    settings = {"maxDepth": 6, "minInstancesPerNode": 15, "seed": 42}
    settings |= {"cacheNodeIds": False, "checkpointInterval": 2, **params}
    return GBTClassifier(labelCol=S.LABEL, featuresCol=FEATURES, **settings)


def _tree_value(node, features: Column) -> Column:
    """A regression tree as nested conditions."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    left, right = (_tree_value(n, features) for n in (node.leftChild(), node.rightChild()))
    value = F.get(features, F.lit(split.featureIndex()))
    if split.getClass().getSimpleName() == "ContinuousSplit":
        goes_left = value <= F.lit(float(split.threshold()))
    else:
        goes_left = value.isin([float(c) for c in split.leftCategories()])
    return F.when(goes_left, left).otherwise(right)


def probability_of_trees(model: GBTClassificationModel, features: Column) -> Column:
    """The model's probability of the positive label, spelled out over an array of features."""
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        margin += float(weight) * _tree_value(tree._call_java("rootNode"), features)
    return 1 / (1 + F.exp(-2 * margin))


def challenger_classifier() -> GBTClassifier:
    return gradient_boosted_trees(minInstancesPerNode=1000)


def with_classifier(features: Pipeline, classifier: Estimator) -> Pipeline:
    return Pipeline(stages=[*features.getStages(), classifier])


def get_fraud_detection_model_pipeline(classifier: Estimator | None = None) -> Pipeline:
    """The feature pipeline followed by a classifier."""
    return with_classifier(
        get_feature_extraction_pipeline(), classifier or gradient_boosted_trees()
    )


def with_last_stage_replaced(pipeline: Pipeline, classifier: Estimator) -> Pipeline:
    return Pipeline(stages=[*pipeline.getStages()[:-1], classifier])

