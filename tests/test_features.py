from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import features

NAN = float("nan")


def column(spark, values, kind="double", name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def values_of(df, name="x"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_binarize_edges(spark):
    df = features.binarize(column(spark, [None, NAN, 0.0, -1.0, 0.5, 3.0]), ["x"])
    assert values_of(df) == [None, 1.0, 0.0, -1.0, 1.0, 1.0]


def test_binarize_keeps_integers(spark):
    df = features.binarize(column(spark, [None, 0, -2, 7], "int"), ["x"], ["y"])
    assert dict(df.dtypes)["y"] == "int"
    assert values_of(df, "y") == [None, 0, -2, 1]
    assert values_of(df) == [None, 0, -2, 7]


def test_cap_edges(spark):
    df = features.cap_outliers(column(spark, [None, NAN, 0.0, -1.0, 5.0, 5.0001]), {"x": 5.0})
    assert values_of(df) == [None, 5.0, 0.0, -1.0, 5.0, 5.0]


def test_cap_widens_integers(spark):
    df = features.cap_outliers(column(spark, [1, 9], "int"), {"x": 2.5})
    assert dict(df.dtypes)["x"] == "double"
    assert values_of(df) == [1.0, 2.5]


def test_time_parts_edges(spark):
    offsets = [0, 59, 3599, 86399, 604799, 604800, -3700]
    df = features.add_time_parts(column(spark, offsets, "bigint", S.TIME))
    found = [
        (r["weekdays"], r["hours"], r["minutes"]) for r in df.orderBy("i").collect()
    ]
    assert found == [
        (0, 0, 0),
        (0, 0, 0),
        (0, 0, 59),
        (0, 23, 59),
        (6, 23, 59),
        (0, 0, 0),
        (0, -1, -1),
    ]


def test_fill_into_new_column(spark):
    df = features.fill_missing(column(spark, [None, NAN, 2.0]), -999.0, ["x"], ["y"])
    assert values_of(df, "y") == [-999.0, -999.0, 2.0]
    kept = values_of(df)
    assert kept[0] is None and math.isnan(kept[1])


def test_fill_keeps_integer_type(spark):
    df = features.fill_missing(column(spark, [None, 2], "int"), -999.0, ["x"])
    assert dict(df.dtypes)["x"] == "int"
    assert values_of(df) == [-999, 2]


def test_text_of_doubles(spark):
    df = features.discrete_to_text(column(spark, [1.0, -999.0, None]), ["x"], ["t"])
    assert values_of(df, "t") == ["1.0", "-999.0", None]


def test_lists_must_match(spark):
    with pytest.raises(ValueError):
        features.binarize(column(spark, [1.0]), ["x"], ["a", "b"])


def test_order_of_the_chain(spark, transactions):
    """A NaN is capped before it could be filled; a missing binary is its own category."""
    row = transactions.limit(1).withColumns(
        {
            "V26": F.lit(None).cast("double"),
            "V286": F.lit(NAN),
            "C7": F.lit(NAN),
            "addr1": F.lit(None).cast("double"),
        }
    )
    found = features.prepare_features(row).first()
    assert found["V26_str"] == "-999.0"
    assert found["V286_str"] == "1.0"
    assert found["C7"] == S.CAP_THRESHOLDS["C7"]
    assert found["addr1"] == 0.0


doubles = st.one_of(st.none(), st.floats(width=64))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(values=st.lists(doubles, min_size=1, max_size=30))
def test_properties(spark, values):
    raw = column(spark, values)
    once = features.binarize(raw, ["x"])
    assert repr(values_of(features.binarize(once, ["x"]))) == repr(values_of(once))

    capped = features.cap_outliers(raw, {"x": 4.0})
    assert repr(values_of(features.cap_outliers(capped, {"x": 4.0}))) == repr(values_of(capped))
    assert all(v is None or v <= 4.0 for v in values_of(capped))

    filled = values_of(features.fill_missing(raw, 0.0, ["x"]))
    assert all(v is not None and not math.isnan(v) for v in filled)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(offsets=st.lists(st.integers(0, 10**10), min_size=1, max_size=50))
def test_time_part_ranges(spark, offsets):
    df = features.add_time_parts(column(spark, offsets, "bigint", S.TIME))
    for row in df.collect():
        assert 0 <= row["weekdays"] < 7
        assert 0 <= row["hours"] < 24
        assert 0 <= row["minutes"] < 60
