"""Spark ML transformers over the feature functions, usable in saved pipelines.

Every transformer takes either one column (``inputCol``) or several
(``inputCols``); those that make new columns take ``outputCol(s)`` to match.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskweave.operators import features, selection


class _ColumnTransformer(
    Transformer, HasInputCol, HasInputCols, DefaultParamsReadable, DefaultParamsWritable
):
    """Column parameters, their setters and their validation."""

    def __init__(self, **params) -> None:
        super().__init__()
        self.setParams(**params)

    def setParams(self, **params):
        return self._set(**{name: v for name, v in params.items() if v is not None})

    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setInputCols(self, value: list[str]):
        return self._set(inputCols=value)

    def _one_or_many(self, single: str, several: str) -> list[str]:
        one, many = self.isSet(single), self.isSet(several)
        if one == many:
            raise ValueError(f"set exactly one of {single} and {several}")
        return [self.getOrDefault(single)] if one else list(self.getOrDefault(several))

    def input_columns(self) -> list[str]:
        return self._one_or_many("inputCol", "inputCols")

    def checkParams(self) -> None:
        self.input_columns()


class _MappingTransformer(_ColumnTransformer, HasOutputCol, HasOutputCols):
    """A transformer with one output column per input column."""

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)

    def setOutputCols(self, value: list[str]):
        return self._set(outputCols=value)

    def output_columns(self) -> list[str]:
        if self.isSet("inputCol"):
            if not self.isSet("outputCol"):
                raise ValueError("inputCol needs outputCol")
            return [self.getOutputCol()]
        outputs = self._one_or_many("outputCol", "outputCols")
        if len(outputs) != len(self.input_columns()):
            raise ValueError("inputCols and outputCols differ in length")
        return outputs

    def checkParams(self) -> None:
        super().checkParams()
        self.output_columns()


class DiscreteToBinaryTransformer(_MappingTransformer):
    """Anything above zero becomes 1; zero, negatives and NULL stay."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.binarize(dataset, self.input_columns(), self.output_columns())


def _float_list(value) -> list[float]:
    return TypeConverters.toListFloat(list(value) if isinstance(value, Iterable) else [value])


class ContinuousOutliersCapper(_ColumnTransformer):
    """Caps columns in place, each at its own ``maximum`` (a number for one column)."""

    maximum = Param(Params._dummy(), "maximum", "upper cap of each input column", _float_list)

    def setMaximum(self, value):
        return self._set(maximum=value)

    def getMaximum(self) -> list[float]:
        return self.getOrDefault(self.maximum)

    def checkParams(self) -> None:
        if len(self.input_columns()) != len(self.getMaximum()):
            raise ValueError("maximum needs one value per input column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.checkParams()
        caps = dict(zip(self.input_columns(), self.getMaximum(), strict=True))
        return features.cap_outliers(dataset, caps)


class OutlierCapEstimator(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a cap for each column whose maximum is far beyond a high quantile.

    The cap is the quantile; far is more than a standard deviation. Columns that are
    not far stay as they are. A ``quantileError`` above 0 learns from one scan.
    """

    quantile = Param(Params._dummy(), "quantile", "rank of the cap", TypeConverters.toFloat)
    quantileError = Param(
        Params._dummy(), "quantileError", "rank error of the cap, 0 for none", TypeConverters.toFloat
    )

    def __init__(
        self,
        inputCols: list[str] | None = None,
        quantile: float = 0.99,
        quantileError: float = 0.0,
    ) -> None:
        super().__init__()
        self._set(quantile=quantile, quantileError=quantileError)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, dataset: DataFrame) -> OutlierCapModel:
        found = selection.tails(
            dataset,
            self.getInputCols(),
            self.getOrDefault(self.quantile),
            self.getOrDefault(self.quantileError),
        )
        caps = {c: tail.quantile for c, tail in found.items() if tail.is_far}
        return OutlierCapModel(list(caps), list(caps.values()))


class OutlierCapModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Caps the columns that were found to need it, in place."""

    maximum = Param(Params._dummy(), "maximum", "learned cap of each column", TypeConverters.toListFloat)

    def __init__(self, inputCols: list[str] | None = None, maximum: list[float] | None = None) -> None:
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), maximum=list(maximum))

    def caps(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.maximum), strict=True))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        caps = self.caps()
        return features.cap_outliers(dataset, caps) if caps else dataset


class TimeFeaturesGenerator(_ColumnTransformer):
    """Adds ``weekdays``, ``hours`` and ``minutes`` of the first input column."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.add_time_parts(dataset, self.input_columns()[0])


class ScalarNAFiller(_MappingTransformer):
    """Replaces NULL and NaN with the number ``filler``."""

    filler = Param(
        Params._dummy(), "filler", "number put in place of missing values", TypeConverters.toFloat
    )

    def setFiller(self, value: float):
        return self._set(filler=value)

    def getFiller(self) -> float:
        return self.getOrDefault(self.filler)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.fill_missing(
            dataset, self.getFiller(), self.input_columns(), self.output_columns()
        )


class StringFromDiscrete(_MappingTransformer):
    """Casts discrete columns to text, ready for indexing."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.discrete_to_text(dataset, self.input_columns(), self.output_columns())
