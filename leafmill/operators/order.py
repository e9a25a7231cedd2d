"""Positions within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import stage


def with_positions(frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the row's place (from 0) among the rows of its keys, by ``order``.

    The rows are range-sorted over keys and order and staged with their range, so a
    group spreads over as many ranges as its size asks for. A row's place is its place
    in the range plus the group's rows in the ranges before, which are counted. NULL
    keys form a group. Rows equal in keys and order share a range; their places are
    dealt among them. Runs when called, not when the result is read.
    """
    ranged = frame.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    held = stage(ranged, "ordered")
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counted = held.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    offsets = counted.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    same = F.col("_range") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    placed = held.withColumn("_inside", inside).join(offsets, same)
    return placed.select(*frame.columns, (F.col("_inside") + F.col("_before")).cast("bigint").alias(name))
