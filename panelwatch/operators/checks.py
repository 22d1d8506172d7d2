"""Constraints as jobs: Spark does not enforce keys, references or NOT NULL.

All checks give rows `constraint, violations`, also for constraints that hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.operators.lookup import fits_broadcast
from panelwatch.session import materialise

WHOLE = ("tinyint", "smallint", "int", "bigint")


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def counted(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Rows that meet each SQL condition, all counted in one pass.

    Only rows that meet one of them are looked at. As a filter on the table's own columns, that is answered
    by the statistics of its files where no row can meet any.
    """
    some = reduce(or_, [F.expr(condition) for condition in conditions.values()])
    counts = df.where(some).agg(*[F.expr(f"count_if({condition})").alias(name) for name, condition in conditions.items()])
    rows = ", ".join(f"'{name}', `{name}`" for name in conditions)
    return counts.selectExpr(f"stack({len(conditions)}, {rows}) AS (constraint, violations)")


def not_null(table: str, columns: Sequence[str]) -> dict[str, str]:
    """Conditions for `counted`."""
    return {f"{table}.{c} not null": f"{c} IS NULL" for c in columns}


def _for_each(names: Sequence[str], found: DataFrame, number: str) -> DataFrame:
    """One row per constraint, with 0 violations for those of which nothing was counted."""
    listed = found.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias(number, "constraint")
    )
    # As many rows as there are constraints on either side.
    joined = listed.join(F.broadcast(found), number, "left")
    return joined.select("constraint", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))


Key = tuple[str, DataFrame, Sequence[str]]


def duplicate_keys(keys: Sequence[Key]) -> DataFrame:
    """Key values that occur more than once, for `(constraint, table, key columns)`. NULL counts as a value.

    A key of one whole number is a bit in a bitmap (`repeated_numbers`), all others are counted one by one.
    """
    numbers = [k for k in keys if len(k[2]) == 1 and dict(k[1].dtypes)[k[2][0]] in WHOLE]
    others = [k for k in keys if k not in numbers]
    parts = [*([repeated_numbers(numbers)] if numbers else []), *([repeated_values(others)] if others else [])]
    return stack(parts)


def repeated_numbers(keys: Sequence[Key]) -> DataFrame:
    """`duplicate_keys` for keys of one whole number each.

    Each task makes bitmaps of 32,768 neighbouring numbers, and only these are shuffled: a key is a bit
    there, however wide or many its rows are. A bucket with as many rows as bits has no repeated number. Only
    in the others, which are none as a rule, are the numbers themselves counted.
    """
    stacked = stack([df.select(F.lit(i).alias("_number"), F.col(c[0]).cast("bigint").alias("_key")) for i, (_, df, c) in enumerate(keys)])
    bucketed = stacked.withColumn("_bucket", F.bitmap_bucket_number("_key"))
    buckets = bucketed.groupBy("_number", "_bucket").agg(
        F.count("*").alias("_n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_key"))).alias("_bits")
    )
    crowded = materialise(buckets.where((F.col("_n") > F.col("_bits")) & (F.col("_n") > 1)).select("_number", "_bucket"), "crowded")
    names = [name for name, _, _ in keys]
    if crowded.isEmpty():
        return _for_each(names, crowded.select("_number", F.lit(0).cast("bigint").alias("violations")), "_number")
    # NULLs are in a bucket of their own.
    some = F.broadcast(crowded) if fits_broadcast(crowded) else crowded
    same = [bucketed["_number"] == crowded["_number"], bucketed["_bucket"].eqNullSafe(crowded["_bucket"])]
    per_key = bucketed.join(some, same, "left_semi").groupBy("_number", "_key").agg(F.count("*").alias("_n"))
    found = per_key.groupBy("_number").agg(F.count_if(F.col("_n") > 1).alias("violations"))
    return _for_each(names, found, "_number")


def repeated_values(keys: Sequence[Key]) -> DataFrame:
    """`duplicate_keys` for keys of any columns.

    All keys are counted in one shuffle, under numbers instead of names: whole numbers in columns
    of their own type and all else as text.
    """

    def split(df: DataFrame, columns: Sequence[str]) -> tuple[list[Column], list[Column]]:
        kinds = dict(df.dtypes)
        whole = [F.col(c).cast("bigint") for c in columns if kinds[c] in WHOLE]
        return whole, [F.col(c).cast("string") for c in columns if kinds[c] not in WHOLE]

    parts = [split(df, columns) for _, df, columns in keys]
    wide = [max((len(p[k]) for p in parts), default=0) for k in (0, 1)]
    names = [[f"_{kind}{i}" for i in range(n)] for kind, n in zip(("whole", "text"), wide)]

    def filled(values: list[Column], names: list[str], kind: str) -> list[Column]:
        missing = [F.lit(None).cast(kind)] * (len(names) - len(values))
        return [v.alias(n) for v, n in zip([*values, *missing], names)]

    stacked = stack(
        [
            df.select(F.lit(i).alias("_number"), *filled(whole, names[0], "bigint"), *filled(text, names[1], "string"))
            for i, ((_, df, _), (whole, text)) in enumerate(zip(keys, parts))
        ]
    )
    per_key = stacked.groupBy("_number", *names[0], *names[1]).agg(F.count("*").alias("_n"))
    found = per_key.groupBy("_number").agg(F.count_if(F.col("_n") > 1).alias("violations"))
    return _for_each([name for name, _, _ in keys], found, "_number")


def missing_references(
    tables: Mapping[str, DataFrame], references: Mapping[str, Mapping[str, tuple[str, str]]]
) -> DataFrame:
    """Distinct non-NULL keys without a row in the dimension they refer to.

    `references` maps a table to its columns, and each to a dimension and that one's
    key. Each column is read by itself and reduced to its distinct keys, so that no row is
    repeated; only they are compared, never the rows.
    """
    checked = [(t, column, *target) for t, columns in references.items() for column, target in columns.items()]
    targets = sorted({(dim, key) for _, _, dim, key in checked})

    def used_by(number: int, table: str, column: str, target: int) -> DataFrame:
        keys = tables[table].select(F.col(column).cast("bigint").alias("_key")).distinct()
        return keys.select(F.lit(number).alias("_reference"), F.lit(target).alias("_target"), "_key")

    used = stack([used_by(i, t, column, targets.index((dim, key))) for i, (t, column, dim, key) in enumerate(checked)])
    known = stack(
        [
            tables[dim].selectExpr(f"{number} AS _target", f"CAST({key} AS BIGINT) AS _key", "true AS _found")
            for number, (dim, key) in enumerate(targets)
        ]
    )
    names = [f"{t}.{column} references {dim}" for t, column, dim, _ in checked]
    orphan = F.col("_key").isNotNull() & F.col("_found").isNull()
    per_reference = (
        used.join(known, ["_target", "_key"], "left")
        .groupBy("_reference")
        .agg(F.count_if(orphan).alias("violations"))
    )
    return _for_each(names, per_reference, "_reference")
