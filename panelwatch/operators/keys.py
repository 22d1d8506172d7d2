"""Surrogate keys 1..n in the order of a natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.session import materialise

ONE_TASK_ROWS = 500_000


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    key: str,
    dtype: str = "bigint",
    *,
    small: bool | None = None,
) -> DataFrame:
    """Add `key` = 1..n in the order of `order`, which must be unique.

    A table proven small is numbered in one task. A larger one is range partitioned;
    every range is numbered on its own and shifted by the number of rows before it.
    `small` passes on a size check that the caller has made.
    """
    if small is None:
        small = df.count() <= ONE_TASK_ROWS
    if small:
        number = F.row_number().over(Window.orderBy(*order))
        return df.withColumn(key, number.cast(dtype))
    ranges = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "key_ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so at most as many as there are shuffle partitions.
    shifts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.join(F.broadcast(shifts), "_range")
        .withColumn(key, (F.col("_shift") + within).cast(dtype))
        .drop("_range", "_shift")
    )
