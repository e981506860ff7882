from __future__ import annotations

import pytest
from pyspark.ml import Pipeline, PipelineModel

from riskweave.operators.transformers import (
    ContinuousOutliersCapper,
    DiscreteToBinaryTransformer,
    ScalarNAFiller,
    StringFromDiscrete,
    TimeFeaturesGenerator,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, 2.0, None), (2, 0.0, 9.0), (3, None, 1.0)], "TransactionDT bigint, a double, b double"
    )


def column(df, name):
    return [r[name] for r in df.orderBy("TransactionDT").collect()]


def test_single_column_forms(rows):
    assert column(DiscreteToBinaryTransformer(inputCol="a", outputCol="x").transform(rows), "x") == [
        1.0,
        0.0,
        None,
    ]
    assert column(ContinuousOutliersCapper(inputCol="b", maximum=5).transform(rows), "b") == [
        None,
        5.0,
        1.0,
    ]
    assert column(ScalarNAFiller(inputCol="b", outputCol="x", filler=-1).transform(rows), "x") == [
        -1.0,
        9.0,
        1.0,
    ]
    assert column(StringFromDiscrete(inputCol="a", outputCol="x").transform(rows), "x") == [
        "2.0",
        "0.0",
        None,
    ]
    timed = TimeFeaturesGenerator(inputCol="TransactionDT").transform(rows)
    assert column(timed, "minutes") == [0, 0, 0]


def test_setters(rows):
    filler = ScalarNAFiller().setInputCols(["a", "b"]).setOutputCols(["c", "d"]).setFiller(0)
    assert column(filler.transform(rows), "d") == [0.0, 9.0, 1.0]
    capper = ContinuousOutliersCapper().setInputCols(["a"]).setMaximum([1.0])
    assert capper.getMaximum() == [1.0]
    assert column(capper.transform(rows), "a") == [1.0, 0.0, None]


@pytest.mark.parametrize(
    "stage",
    [
        DiscreteToBinaryTransformer(),
        DiscreteToBinaryTransformer(inputCol="a", outputCol="x", inputCols=["a"], outputCols=["x"]),
        DiscreteToBinaryTransformer(inputCols=["a", "b"], outputCols=["x"]),
        DiscreteToBinaryTransformer(inputCol="a"),
        StringFromDiscrete(inputCols=["a"]),
        ScalarNAFiller(inputCols=["a"], outputCols=["x", "y"], filler=0.0),
        ContinuousOutliersCapper(inputCols=["a", "b"], maximum=[1.0]),
        TimeFeaturesGenerator(),
    ],
    ids=lambda s: type(s).__name__,
)
def test_wrong_parameters_are_refused(rows, stage):
    with pytest.raises(ValueError):
        stage.checkParams()
    with pytest.raises(ValueError):
        stage.transform(rows)


def test_saved_and_loaded(rows, tmp_path):
    pipeline = Pipeline(
        stages=[
            DiscreteToBinaryTransformer(inputCols=["a"], outputCols=["a"]),
            ContinuousOutliersCapper(inputCols=["b"], maximum=[5.0]),
            TimeFeaturesGenerator(inputCols=["TransactionDT"]),
            ScalarNAFiller(inputCols=["a"], outputCols=["a"], filler=-999.0),
            StringFromDiscrete(inputCols=["a"], outputCols=["t"]),
        ]
    )
    model = pipeline.fit(rows)
    path = str(tmp_path / "model")
    model.save(path)
    loaded = PipelineModel.load(path)
    assert [type(s) for s in loaded.stages] == [type(s) for s in model.stages]
    order = "TransactionDT"
    assert loaded.transform(rows).orderBy(order).collect() == model.transform(rows).orderBy(order).collect()
