"""Exact, SQL-checkable forms of the indexing, one-hot and scaling stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators.features import prepare_features, text_column
from riskweave.operators.joins import DEFAULT_BOUND, BroadcastBound, measure, sized_join
from riskweave.operators.quantiles import exact_quantiles
from riskweave.operators.running import running_totals
from riskweave.sources.workspace import settle


def label_index(
    df: DataFrame, column: str, bound: BroadcastBound = DEFAULT_BOUND
) -> DataFrame:
    """``label, n, index``: labels by descending count, ties by label, from 0.

    A dictionary measured as small is ranked in one window; a larger one by running
    totals over a distributed sort.
    """
    counts = settle(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.col("n").desc(), F.col("label").asc()]
    if measure(counts).within(bound):
        position = F.row_number().over(Window.orderBy(*order)) - 1
        return counts.withColumn("index", position.cast("bigint"))
    return running_totals(counts, order, {"index": F.lit(1)})


def one_hot_bits(index: Column, width: int | Column) -> Column:
    """Array of ``width`` zeros with a one at ``index``; all zeros for other indices.

    A row has as many cells as there are labels: for small dictionaries only.
    """
    width = F.lit(width) if isinstance(width, int) else width
    slots = F.when(width > 0, F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(slots, lambda slot: (slot == index).cast("int"))


def one_hot(
    df: DataFrame,
    column: str,
    output: str,
    fitted_on: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    bound: BroadcastBound = DEFAULT_BOUND,
) -> DataFrame:
    """One-hot code of a text column as ``struct<index, width>``, so that a row's size
    does not depend on the number of labels.

    Unseen labels and NULL have index -1: a vector of ``width`` zeros.
    """
    found = label_index(fitted_on if fitted_on is not None else df, column, bound)
    labels = settle(found.select(F.col("label").alias(column), "index"))
    size = measure(labels)
    columns = df.columns
    indexed = sized_join(df, labels, column, "left", size, bound, salt_by)
    index = F.coalesce(F.col("index"), F.lit(-1)).cast("int").alias("index")
    code = F.struct(index, F.lit(size.rows).cast("int").alias("width"))
    return indexed.select(*columns, code.alias(output))


def dense(code: Column) -> Column:
    """The bits of a one-hot code."""
    return one_hot_bits(code["index"], code["width"])


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest value of each column in one pass."""
    aggregates = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    row = df.agg(*aggregates).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in columns}


def min_max_scaled(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` mapped to 0..1; a constant column gives 0.5."""
    if low is None or low == high:
        return F.lit(0.5)
    return (value - F.lit(low)) * F.lit(1.0 / (high - low))


def min_max_scale(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_scaled",
    fitted_on: DataFrame | None = None,
) -> DataFrame:
    limits = fit_min_max(fitted_on or df, columns)
    return df.withColumns({c + suffix: min_max_scaled(F.col(c), *limits[c]) for c in columns})


def fit_interquartile(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact distance between the first and third quartile of each column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    return {c: (0.0 if q[0] is None else q[1] - q[0]) for c, q in quartiles.items()}


def robust_scaled(value: Column, spread: float) -> Column:
    """``value`` in units of ``spread``, without centring; a zero spread gives 0."""
    return value * F.lit(1.0 / spread) if spread else F.lit(0.0)


def robust_scale(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_scaled",
    fitted_on: DataFrame | None = None,
) -> DataFrame:
    spreads: Mapping[str, float] = fit_interquartile(fitted_on or df, columns)
    return df.withColumns({c + suffix: robust_scaled(F.col(c), spreads[c]) for c in columns})


def feature_arrays(df: DataFrame, key: str = S.TRANSACTION_ID) -> DataFrame:
    """The final feature vector in exact parts, from raw transactions.

    ``onehot_*`` codes, then the scaled discrete and continuous columns.
    """
    prepared = prepare_features(df).select(
        key,
        *[text_column(c) for c in S.BINARY_FEATURES],
        *S.DISCRETE_FEATURES,
        *S.CONTINUOUS_FEATURES,
    )
    scaled = min_max_scale(prepared, S.DISCRETE_FEATURES)
    scaled = robust_scale(scaled, S.CONTINUOUS_FEATURES, fitted_on=prepared)
    for c in S.BINARY_FEATURES:
        scaled = one_hot(scaled, text_column(c), f"onehot_{c}", prepared, salt_by=[key])
    names = S.DISCRETE_FEATURES + S.CONTINUOUS_FEATURES
    return scaled.select(
        key,
        *[f"onehot_{c}" for c in S.BINARY_FEATURES],
        *[f"{c}_scaled" for c in names],
    )


def as_feature_array(parts: DataFrame, key: str = S.TRANSACTION_ID) -> DataFrame:
    """One dense double array per row, in the order of the assembled vector."""
    names = S.DISCRETE_FEATURES + S.CONTINUOUS_FEATURES
    pieces = [dense(F.col(f"onehot_{c}")).cast("array<double>") for c in S.BINARY_FEATURES]
    scalars = F.array(*[F.col(f"{c}_scaled").cast("double") for c in names])
    return parts.select(key, F.concat(*pieces, scalars).alias("features"))
