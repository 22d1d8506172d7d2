"""Connected components of an edge table, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.session import materialise


def _stars(pairs: DataFrame) -> DataFrame:
    """Every u of (u, v) with the least of its v and itself, as `least`; written, so that the join with
    it is one of plain shuffles, in which a node with very many edges can be split."""
    return materialise(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), "least")


def _large(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.where("v > u").join(_stars(both), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Hang a node's smaller neighbours, and the node itself, on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _stars(down)
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.unionAll(least.select("u", F.col("least").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v), root being the least node of its component.

    Large and small stars alternate until nothing changes, which takes a number of rounds that grows with
    the logarithm of the longest path. A round moves one row per edge, minima are combined before the
    shuffle, and a node with very many edges is split by adaptive execution.
    Roots themselves are not listed.
    """
    state = materialise(edges.where("u != v").distinct(), "edges")
    mark = None
    while True:
        row = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == row or not row[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = row
        state = materialise(_small(_large(state)), "stars")
