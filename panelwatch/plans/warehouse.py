"""Build the warehouse from raw tables, and open one that is there."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.operators.lookup import BROADCAST_ROWS, fits_broadcast
from panelwatch.plans import analytics, dimensions, facts, layers, quality, staging
from panelwatch.plans.dimensions import RawTables
from panelwatch.plans.schema import CALENDAR, PARTITIONED_BY, TABLES, columns
from panelwatch.session import materialise, run_together
from panelwatch.sources import pointer
from panelwatch.sources.claims import holding
from panelwatch.sources.ingest import DATASETS
from panelwatch.sources.store import RawStore

WAREHOUSE = "warehouse"


class QualityError(RuntimeError):
    """The build is complete but its checks failed."""


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    # A partition column is read last; the declared order is restored.
    return spark.read.schema(TABLES[table]).parquet(table_path(root, table)).select(*columns(table))


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite") -> DataFrame:
    """Write columns by name. A partitioned table is rebalanced by its partition first:
    files get an even size, and a partition holding much of the data gets many."""
    shaped = df.select(*columns(table))
    partition = PARTITIONED_BY.get(table)
    if partition is None:
        shaped.write.mode(mode).parquet(table_path(root, table))
    else:
        balanced = shaped.hint("rebalance", F.col(partition))
        balanced.write.mode(mode).partitionBy(partition).parquet(table_path(root, table))
    return read_table(df.sparkSession, root, table)


def load_dimensions(
    raw: RawTables, root: str, calendar: tuple[str, str] = CALENDAR
) -> dict[str, DataFrame]:
    spark = raw.flu.sparkSession
    members = materialise(dimensions.members(raw), "members")
    # No dimension drawn from the members has more rows than they, the unknown county aside.
    small = fits_broadcast(members, BROADCAST_ROWS - 1)
    built = {
        "dim_disease": dimensions.disease_dimension(spark).coalesce(1),
        "dim_gender": dimensions.gender_dimension(spark).coalesce(1),
        "dim_date": dimensions.calendar_dimension(spark, *calendar),
        "dim_age_group": dimensions.age_dimension(members, small=small or None),
        "dim_geography": dimensions.geography_dimension(members, small=small or None),
    }
    return _write_all(built, root)


def _write_all(built: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    return run_together({name: partial(write_table, df, root, name) for name, df in built.items()})


def staged_tables(raw: RawTables) -> dict[str, DataFrame]:
    return {
        "stg_nhi": staging.stage_nhi(raw.flu, raw.ev),
        "stg_covid": staging.stage_covid(raw.covid),
        "stg_dengue": staging.stage_dengue(raw.dengue),
    }


def load_facts(
    staged: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], root: str
) -> dict[str, DataFrame]:
    dims = facts.Dimensions(dims)
    loaded = {
        "fact_nhi_visits": facts.load_nhi(staged["stg_nhi"], dims),
        "fact_covid_cases": facts.load_covid(staged["stg_covid"], dims),
        "fact_dengue_cases": facts.load_dengue(staged["stg_dengue"], dims),
    }
    return _write_all(loaded, root)


def build(
    raw: RawTables, root: str, calendar: tuple[str, str] = CALENDAR, *, check: bool = True
) -> dict[str, DataFrame]:
    """Build every table in a new folder below `root`, check it, then publish it.

    Repeating a build gives the same tables. Readers keep the build before until the new
    one has passed its checks.
    """
    spark = raw.flu.sparkSession
    version = pointer.new_version()
    path = f"{root.rstrip('/')}/{version}"
    tables = load_dimensions(raw, path, calendar)
    staged = staged_tables(raw)
    tables |= load_facts(staged, tables, path)
    jobs = {
        "agg_weekly": lambda: write_table(analytics.weekly_sparse(tables), path, "agg_weekly"),
        "agg_monthly": lambda: write_table(analytics.monthly_sparse(tables), path, "agg_monthly"),
    }
    reports = quality.build_reports(staged, tables) if check else {}
    jobs |= {name: partial(_failed, report) for name, report in reports.items()}
    done = run_together(jobs)
    failed = sorted(failure for name in reports for failure in done[name])
    if failed:
        raise QualityError(", ".join(failed))
    tables |= {name: done[name] for name in ("agg_weekly", "agg_monthly")}
    tables |= run_together({name: partial(layers.write_layer, tables, path, name) for name in layers.LAYERS})
    pointer.publish(spark, _log(root), WAREHOUSE, version, path)
    return tables


def _failed(report: Callable[[], DataFrame]) -> list[str]:
    """The checks of a report that do not hold; there is one row per check."""
    return [row["check"] for row in report().where("ok IS NOT TRUE").collect()]


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/builds"


def open_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame] | None:
    """The tables of the last published build, or None."""
    path = pointer.current(spark, _log(root), WAREHOUSE)
    if path is None:
        return None
    return {name: read_table(spark, path, name) for name in TABLES} | layers.read_layers(spark, path)


def ensure(
    spark: SparkSession,
    root: str,
    raw: Callable[[], RawTables],
    calendar: tuple[str, str] = CALENDAR,
) -> dict[str, DataFrame]:
    """Open the warehouse, or build it first if it is not there.

    Of several callers that find none, in one process or many, one builds and the others wait for it. If its
    build fails, the next one tries.
    """
    there = open_warehouse(spark, root)
    if there is None:
        with holding(spark, f"{root.rstrip('/')}/building"):
            there = open_warehouse(spark, root) or build(raw(), root, calendar)
    return there


def raw_tables(spark: SparkSession, store: RawStore) -> RawTables:
    """The latest version of each source dataset."""
    return RawTables(**{role: store.latest(spark, name) for role, (name, _) in DATASETS.items()})
