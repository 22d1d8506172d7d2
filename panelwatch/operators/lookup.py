"""Joins of a large table with a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.session import materialise

# Rows of a few short columns each.
BROADCAST_ROWS = 200_000
# Rows of two numbers each, some 60 MB as a hash table.
NARROW_BROADCAST_ROWS = 1_000_000
# A key with more than one piece's share of the rows is hot and is cut into pieces.
PIECES = 1000


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a dimension is proven small. For a written table the file footers tell."""
    return dim.count() <= max_rows


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    small: bool | None = None,
    keys_of: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    pieces: int = PIECES,
) -> DataFrame:
    """Join `facts` to a dimension that is unique in `on`, inner or left.

    A dimension proven small is broadcast, so the facts do not move. A larger one is
    joined by `split_join`. The result is the same either way. `small` passes on a size
    check that the caller has made; `keys_of` and `salt_by` are explained there.
    """
    if small is None:
        small = fits_broadcast(dim)
    if small:
        return facts.join(F.broadcast(dim), list(on), how)
    return split_join(facts, dim, on, how, keys_of=keys_of, salt_by=salt_by, pieces=pieces)


def split_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    keys_of: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    pieces: int = PIECES,
) -> DataFrame:
    """A shuffled join that spreads hot keys.

    The rows per key are counted first, combined before the shuffle. A key with more
    than 1/`pieces` of all rows is hot; there are fewer than `pieces` of them. Its rows
    are dealt out to as many salts as it has pieces, and its dimension row is repeated
    once per salt. All other keys have the one salt 0. Rows with a NULL key, which match
    nothing, are dealt out as well.

    The counts only steer how rows are dealt out. `keys_of` names a table to count in
    that is cheaper than `facts`, such as the one they were joined from.

    A row's salt is a hash of its own columns, so it is the same if a task runs again, wherever
    the rows come from and in whatever order. `salt_by` names columns that tell rows apart well
    enough, such as an id; all of them are taken by default. Equal rows share a salt; adaptive
    execution can still split their partition, as the join is a plain one.
    """
    on = list(on)
    counts = (facts if keys_of is None else keys_of).groupBy(*on).agg(F.count("*").alias("_n"))
    piece = F.greatest(F.lit(1), counts.agg(F.ceil(F.sum("_n") / F.lit(pieces))).scalar())
    hot = materialise(
        counts.where(F.col("_n") > piece).select(*on, F.ceil(F.col("_n") / piece).cast("int").alias("_salts")),
        "hot_keys",
    )

    def with_salts(df: DataFrame) -> DataFrame:
        # Fewer rows than `pieces`, as their shares of the facts add up to one.
        return df.join(F.broadcast(hot), on, "left")

    place = F.xxhash64(F.lit(1), *_hashable(facts, facts.columns if salt_by is None else salt_by))
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    salts = F.when(no_key, F.lit(pieces)).otherwise(F.coalesce(F.col("_salts"), F.lit(1)))
    salted = with_salts(facts).withColumn("_salt", F.pmod(place, salts).cast("int"))
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    spread = with_salts(dim).withColumn("_salt", F.explode(repeats))
    return salted.drop("_salts").join(spread.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns as values that can be hashed; maps, alone or nested, are hashed as JSON."""
    kinds = dict(df.dtypes)
    quoted = {name: F.col("`" + name.replace("`", "``") + "`") for name in names}
    return [F.to_json(F.struct(c)) if "map<" in kinds[name] else c for name, c in quoted.items()]


def every_pair(left: DataFrame, right: DataFrame, right_key: str, buckets: int | None = None) -> DataFrame:
    """All pairs of two dimension-sized tables, for a panel's spine.

    The pairs are wanted in full. They are made by an equi-join on a bucket of the right
    side instead of a nested loop, so the work spreads over `buckets` tasks, by default as many as a shuffle has.
    """
    if buckets is None:
        buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = right.withColumn("_bucket", F.pmod(F.xxhash64(right_key), F.lit(buckets)).cast("int"))
    repeated = left.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return repeated.join(numbered, "_bucket").drop("_bucket")
