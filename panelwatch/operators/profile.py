"""Profiles of untyped columns, one pass per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.clean import is_blank

LG_K = 14


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, value, n_rows`: the distinct values of several columns."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, min_value, max_value, n_distinct, n_blank, n_rows` as text columns see them."""
    counts = value_counts(df, columns)
    return counts.groupBy("column_name").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("value").alias("n_distinct"),
        F.sum(F.when(is_blank(F.col("value")), F.col("n_rows")).otherwise(0)).alias("n_blank"),
        F.sum("n_rows").alias("n_rows"),
    )


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """One row per group of `by` with a sketch of the distinct texts of each column, under the column's name.

    A sketch has at most 2 ** `lg_k` bytes whatever it counts, so what is shuffled is a row of sketches per
    group and task, and no values. Sketches of groups, partitions or days can be stored and merged later.
    """
    # A sketch passes over the empty text, so every text is given a mark.
    marked = [F.concat(F.lit("="), F.col(c).cast("string")) for c in columns]
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(m, F.lit(lg_k)).alias(c) for m, c in zip(marked, columns)])


def merged_estimates(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`column_name, estimate`: distinct values over all rows of sketches, merged."""
    counts = stored.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("estimate")) for c in columns])
    return counts.select(F.inline(cells))


def estimate_bound(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """The relative error that an estimate exceeds with the probability of so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def length_histogram(df: DataFrame, column: str) -> DataFrame:
    """`len, n_rows`: lengths in characters."""
    return df.groupBy(F.length(column).alias("len")).agg(F.count("*").alias("n_rows"))


def shortest_values(df: DataFrame, column: str, below: int, limit: int) -> DataFrame:
    """The first `limit` values shorter than `below`, with their counts."""
    return (
        df.where(F.length(column) < below)
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .orderBy("value")
        .limit(limit)
    )


def values_containing(tables: dict[str, tuple[DataFrame, str]], pattern: str) -> DataFrame:
    """`src, value`: distinct values of one column per table that match a LIKE pattern."""
    parts = [
        df.where(F.col(column).like(pattern)).select(F.lit(src).alias("src"), F.col(column).alias("value"))
        for src, (df, column) in tables.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.distinct()


def distinct_union(parts: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct non-empty values of one column each of several tables."""
    stacked = None
    for df, column in parts:
        one = df.select(F.col(column).alias(name)).where(F.col(name) != "")
        stacked = one if stacked is None else stacked.union(one)
    return stacked.distinct()
