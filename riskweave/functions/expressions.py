"""Column expressions of the feature operators; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60
HOUR = 60 * MINUTE
DAY = 24 * HOUR
WEEK = 7 * DAY


def positive_to_one(value: Column) -> Column:
    """1 for anything above zero (NaN included); zero, negatives and NULL unchanged."""
    return F.when(value > 0, F.lit(1)).otherwise(value)


def capped(value: Column, maximum: float) -> Column:
    """``min(value, maximum)``. NULL stays NULL; NaN sorts largest, so it is capped."""
    return F.when(value.isNotNull(), F.least(value, F.lit(float(maximum))))


def time_parts(offset: Column) -> dict[str, Column]:
    """Day of week, hour and minute of a seconds offset, truncated toward zero.

    Day 0 is the day of offset 0, not a calendar weekday.
    """
    return {
        "weekdays": (offset % WEEK / DAY).cast("int"),
        "hours": (offset % DAY / HOUR).cast("int"),
        "minutes": (offset % DAY % HOUR / MINUTE).cast("int"),
    }


def positive_probability(probability: Column) -> Column:
    """Second entry of a class-probability vector, or NULL for a vector shorter than two."""
    return F.get(vector_to_array(probability), F.lit(1))
