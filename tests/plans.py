"""Physical plan text of a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_python_and_no_cross_join(df: DataFrame) -> bool:
    plan = plan_of(df)
    forbidden = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "NestedLoop")
    return not any(word in plan for word in forbidden)
