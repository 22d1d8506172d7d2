"""Moving averages, period-over-period change, ranks and shares on dense panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.functions.measures import growth_percent, percent, round_half_away


def last_rows_mean(metric: str, line: Sequence[str], period: str, periods: int) -> Column:
    """Mean of the last `periods` rows, of fewer at the start."""
    frame = Window.partitionBy(*line).orderBy(period).rowsBetween(1 - periods, 0)
    return F.avg(metric).over(frame)


def trend(
    dense: DataFrame,
    *,
    line: Sequence[str],
    period: str,
    metric: str,
    averages: Mapping[str, int],
    previous: str,
    change: str,
    growth: str,
) -> DataFrame:
    """Add moving averages (to one digit) and the change against the previous period.

    `line` identifies one time series. All frames share its partitioning and order, so
    they are computed in one pass over one sort; a line is as long as the calendar.
    """
    before = F.lag(metric, 1).over(Window.partitionBy(*line).orderBy(period))
    means = {name: last_rows_mean(metric, line, period, n) for name, n in averages.items()}
    # Rounded in a second step, so that each frame is evaluated once.
    framed = dense.withColumns({**means, previous: before})
    return framed.withColumns(
        {
            **{name: round_half_away(F.col(name), 1) for name in averages},
            change: F.col(metric) - F.col(previous),
            growth: growth_percent(F.col(metric), F.col(previous)),
        }
    )


def rank_and_share(
    dense: DataFrame,
    *,
    within: Sequence[str],
    metric: str,
    rank: str,
    share: str,
    wide: bool = False,
) -> DataFrame:
    """Rank entities by metric, with gaps after ties, and give each its percent of the total.

    A group has one row per entity. With `wide`, a form for entity sets too large for one task
    per group, rows are first counted per distinct metric value: the running count over
    the values above gives the rank, their weighted sum the total. A value that many
    entities share, such as zero, is a hot key on the way back, which adaptive execution
    splits. Both forms are lazy, have the same result, and let filters on `within` through.
    """
    within = list(within)
    if not wide:
        group = Window.partitionBy(*within)
        ordered = group.orderBy(F.col(metric).desc())
        return dense.withColumns(
            {
                rank: F.rank().over(ordered),
                share: percent(F.col(metric), F.sum(metric).over(group)),
            }
        )
    by_value = dense.groupBy(*within, metric).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*within)
    above = group.orderBy(F.col(metric).desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = by_value.select(
        *within,
        metric,
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("int").alias(rank),
        F.sum(F.col("_n") * F.col(metric)).over(group).alias("_total"),
    )
    return (
        dense.join(placed, [*within, metric])
        .withColumn(share, percent(F.col(metric), F.col("_total")))
        .drop("_total")
    )
