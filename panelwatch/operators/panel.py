"""Sparse observations to dense, zero-filled panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.operators.lookup import every_pair

WEEK = "7 days"
MONTH = "1 month"


def sparse_panel(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    metric: Column,
    denominator: Column | None = None,
    names: tuple[str, str] = ("metric_value", "denominator"),
) -> DataFrame:
    """Sum observations to the grain `keys`; one row per key that occurs.

    The sums combine before the shuffle, so a key holding most of the rows arrives as
    one row per input task.
    """
    sums = [F.sum(metric).alias(names[0])]
    if denominator is not None:
        sums.append(F.sum(denominator).alias(names[1]))
    return rows.groupBy(*keys).agg(*sums)


def densify(
    sparse: DataFrame,
    entities: DataFrame,
    *,
    series: Sequence[str],
    entity: str,
    period: str,
    step: str,
    metric: str,
    denominator: str | None = None,
    cluster_by: Sequence[str],
) -> DataFrame:
    """Give every entity a row in every period its series spans.

    A series spans its first to its last observed period, those of entities that are not
    listed included; rows of such entities are left out. A missing metric becomes 0, a
    missing denominator stays NULL.

    Empty cells and observations are stacked and summed per cell, which needs no join.
    `cluster_by` names the columns the following window partitions by: the rows move
    once, by these columns, and neither the sum nor the window shuffles again. A cluster
    holds at most one row per period (or per entity), however large the source is.
    """
    series = list(series)
    cell = [*series, entity, period]
    spans = sparse.groupBy(*series).agg(F.min(period).alias("_from"), F.max(period).alias("_to"))
    pairs = every_pair(spans, entities.select(entity), entity).repartition(*series, entity)
    periods = F.sequence("_from", "_to", F.expr(f"interval {step}"))
    spine = pairs.select(*series, entity, F.explode(periods).alias(period))

    values = [metric] if denominator is None else [metric, denominator]
    no_values = [F.lit(None).cast("bigint").alias(v) for v in values]
    stacked = spine.select(*cell, *no_values, F.lit(True).alias("_wanted")).unionByName(
        sparse.select(*cell, *values, F.lit(False).alias("_wanted"))
    )
    filled = [F.coalesce(F.sum(metric), F.lit(0).cast("bigint")).alias(metric)]
    if denominator is not None:
        filled.append(F.sum(denominator).alias(denominator))
    return (
        stacked.repartition(*cluster_by)
        .groupBy(*cell)
        .agg(*filled, F.max("_wanted").alias("_wanted"))
        .where("_wanted")
        .drop("_wanted")
    )
