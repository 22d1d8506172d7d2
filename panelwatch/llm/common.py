"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.operators.lookup import BROADCAST_ROWS
from panelwatch.session import materialise

# Fixed values of the contracts: what a word is, and the space between words.
WORD = r"[^\x20\x09-\x0D]+"

# Entries of a few numbers each.
BROADCAST_ENTRIES = 2_000_000


def run_anywhere(module: str) -> None:
    """Send the functions of a module to Python workers by value, so that a worker that cannot import
    this package (a session started without --py-files) can run them."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop extra columns whose names an operator needs for its own, in any case of letters."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, name: str) -> str:
    """A name for a passing column that no column of `df` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, name: str, **others: Column) -> DataFrame:
    """All columns of `df` as one struct, beside others made from them; so no names can clash."""
    whole = F.struct(*[df[f"`{c}`"] for c in df.columns])
    return df.select(whole.alias(name), *[c.alias(n) for n, c in others.items()])


def unpacked(df: DataFrame, name: str, *others: Column) -> DataFrame:
    """The columns of a packed struct again, and others behind them."""
    fields = df.schema[name].dataType.names
    return df.select(*[F.col(name).getField(f).alias(f) for f in fields], *others)


def small_lists(table: DataFrame, lists: str) -> bool:
    """Whether a written table with a column of lists may be broadcast: both its rows and all the
    entries of its lists are counted."""
    rows, entries = table.agg(F.count("*"), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and entries <= BROADCAST_ENTRIES


def words_in(text: Column) -> Column:
    """Number of words as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Add a column that tells rows apart, equal ones too, and stays the same if a task runs again.

    It is the row's place in its file, so a table that is no plain scan is written first. (An id
    counted in a task would change if a shuffle below it delivered its rows in another order.)
    The file is named by its whole path, as base names repeat in the folders of a partitioned table.
    """
    try:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row")))
    except AnalysisException:
        df = materialise(df, "rows")
        meta = df.metadataColumn("_metadata")
        return df.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row")))
