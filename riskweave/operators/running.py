"""Running totals over one global order, without a single-partition window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.sources.workspace import settle


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Add, per row, the sum of each total over the rows before it.

    Rows are range-partitioned by a distributed sort and settled, so each keeps
    its partition. Every partition sums locally and is shifted by the sum of the
    partitions before it; those sums are one row per partition, the only thing
    broadcast. ``order_by`` should be unique per row, so that no group of equal
    keys has to stay in one partition: group the input first.
    """
    addends = {f"_add_{name}": value for name, value in totals.items()}
    ordered = settle(
        df.withColumns(addends)
        .orderBy(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = ordered.groupBy("_part").agg(*[F.sum(a).alias(a) for a in addends])
    shifts = per_part.select(
        "_part", *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"{a}_shift") for a in addends]
    )

    within = (
        Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = {f"{a}_local": F.coalesce(F.sum(a).over(within), F.lit(0)) for a in addends}
    return (
        ordered.withColumns(local)
        .join(F.broadcast(shifts), "_part")
        .select(
            *df.columns,
            *[(F.col(f"_add_{n}_shift") + F.col(f"_add_{n}_local")).alias(n) for n in totals],
        )
    )
