"""One warehouse per session and state of a table directory, as a user of the library has it."""

from __future__ import annotations

from dataclasses import fields
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from bindings import feeds
from panelwatch.plans import warehouse
from panelwatch.plans.dimensions import RawTables
from panelwatch.session import materialise, run_together, scratch_path
from panelwatch.sources.files import stamp

_ORDERS = "placed_orders"
_RAW: dict[tuple, dict[str, DataFrame]] = {}
_ROOTS: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Other files under the same path make another warehouse."""
    return (spark.sparkContext.applicationId, sf_dir, stamp(spark, sf_dir))


def sources(spark: SparkSession, sf_dir: str, *roles: str) -> dict[str, DataFrame]:
    """Derived sources, each written as a raw table once, when it is first asked for."""
    kept = _RAW.setdefault(_state(spark, sf_dir), {})
    wanted = [role for role in roles if role not in kept]
    if _ORDERS not in kept and set(wanted) - {"ev"}:
        kept[_ORDERS] = materialise(feeds.placed_orders(spark, sf_dir), _ORDERS)
    made = {role: feeds.source(spark, sf_dir, role, kept.get(_ORDERS)) for role in wanted}
    kept |= run_together({role: partial(materialise, df, f"raw_{role}") for role, df in made.items()})
    return {role: kept[role] for role in roles}


def source(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    return sources(spark, sf_dir, role)[role]


def landed(spark: SparkSession, sf_dir: str) -> RawTables:
    """All of them."""
    return RawTables(**sources(spark, sf_dir, *(field.name for field in fields(RawTables))))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The warehouse on these sources, built on first use."""
    key = _state(spark, sf_dir)
    if key not in _ROOTS:
        _ROOTS[key] = scratch_path(spark, "warehouse")
    return warehouse.ensure(spark, _ROOTS[key], lambda: landed(spark, sf_dir), feeds.CALENDAR)
