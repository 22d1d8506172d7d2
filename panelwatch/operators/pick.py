"""Top groups, extremes, seeded samples and grid densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.measures import round_half_away
from panelwatch.session import materialise


def top_groups(
    df: DataFrame, by: Sequence[str], value: Column, name: str, k: int = 1
) -> DataFrame:
    """The `k` groups with the greatest aggregate; ties go to the lowest group key."""
    ranked = df.groupBy(*by).agg(value.alias(name))
    return ranked.orderBy(F.col(name).desc_nulls_last(), *by).limit(k)


def latest(value: str, period: str) -> Column:
    """Aggregate: `value` in the last period."""
    return F.max_by(value, period)


def peak(value: str, metric: str, period: str) -> Column:
    """Aggregate: `value` where `metric` is greatest, the earliest such period."""
    return F.max_by(value, F.struct(F.col(metric), -F.unix_date(F.col(period))))


def sample_rows(df: DataFrame, cap: int, row_id: Sequence[str], seed: int = 0) -> DataFrame:
    """`cap` rows in the order of a seeded hash of a unique row id; all rows if there
    are no more than that.

    Only rows whose hash is below a threshold are sorted. The threshold leaves about
    `cap` rows with a margin; should it leave too few, all rows are sorted.
    """
    total = df.count()
    if total <= cap:
        return df
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in row_id]))
    hashed = df.withColumn("_digest", digest)
    wanted = min(total, cap + 10 * int(cap**0.5) + 100)
    threshold = f"{min(wanted * 16**8 // total + 1, 16**8 - 1):08x}"

    def first(candidates: DataFrame) -> DataFrame:
        return candidates.orderBy("_digest", *row_id).limit(cap).drop("_digest")

    picked = materialise(first(hashed.where(F.col("_digest") <= F.lit(threshold + "f" * 24))), "sample")
    return picked if picked.count() == cap else first(hashed)


def grid_density(df: DataFrame, lat: str, lon: str, digits: int, by: Sequence[str] = ()) -> DataFrame:
    """Points per grid cell: what a heat map shows, whatever the number of points."""
    return (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(
            *by,
            round_half_away(F.col(lat), digits).alias(lat),
            round_half_away(F.col(lon), digits).alias(lon),
        )
        .agg(F.count("*").alias("n_points"))
    )
