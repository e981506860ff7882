"""Feature preparation as DataFrame-to-DataFrame functions, one projection each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.functions.expressions import capped, positive_to_one, time_parts


def binarize(
    df: DataFrame, inputs: Sequence[str], outputs: Sequence[str] | None = None
) -> DataFrame:
    names = zip(outputs or inputs, inputs, strict=True)
    return df.withColumns({out: positive_to_one(F.col(c)) for out, c in names})


def cap_outliers(df: DataFrame, maximums: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: capped(F.col(c), m) for c, m in maximums.items()})


def add_time_parts(df: DataFrame, offset: str = S.TIME) -> DataFrame:
    return df.withColumns(time_parts(F.col(offset)))


def fill_missing(
    df: DataFrame,
    filler: float,
    inputs: Sequence[str],
    outputs: Sequence[str] | None = None,
) -> DataFrame:
    """NULL and NaN become ``filler``, in the column's own type."""
    outputs = list(outputs or inputs)
    renamed = {o: F.col(i) for o, i in zip(outputs, inputs, strict=True) if o != i}
    return (df.withColumns(renamed) if renamed else df).fillna(filler, subset=outputs)


def discrete_to_text(
    df: DataFrame, inputs: Sequence[str], outputs: Sequence[str]
) -> DataFrame:
    names = zip(outputs, inputs, strict=True)
    return df.withColumns({out: F.col(c).cast("string") for out, c in names})


def text_column(name: str) -> str:
    return f"{name}_str"


def prepare_features(df: DataFrame) -> DataFrame:
    """The row-wise half of the feature pipeline, up to text categories.

    The order matters: caps precede fills (a NaN becomes the cap, a NULL the
    filler) and fills precede the text cast (a missing value is a category).
    """
    df = binarize(df, S.BINARY_FEATURES)
    df = cap_outliers(df, S.CAP_THRESHOLDS)
    df = add_time_parts(df)
    df = fill_missing(df, S.DISCRETE_FILLER, S.BINARY_FEATURES + S.DISCRETE_FEATURES)
    df = fill_missing(df, S.CONTINUOUS_FILLER, S.CONTINUOUS_FEATURES)
    return discrete_to_text(
        df, S.BINARY_FEATURES, [text_column(c) for c in S.BINARY_FEATURES]
    )
