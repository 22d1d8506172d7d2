"""Land CSV sources as raw tables with lineage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.session import run_together
from panelwatch.sources import pointer
from panelwatch.sources.store import RawStore
from panelwatch.sources.text_csv import parse_text_csv

REPORT = (
    "name string, disease string, rows bigint, cols int, source_url string, path string, error string,"
    " primary_error string"
)
# Sources whose jobs are submitted at once.
SIDE_BY_SIDE = 8
# Dataset names, subjects and the views the warehouse reads.
DATASETS = {
    "flu": ("nhi_influenza_like_illness", "流感"),
    "ev": ("nhi_enteroviral_infection", "腸病毒"),
    "covid": ("covid_age_county_gender", "COVID-19"),
    "dengue": ("dengue_daily", "登革熱"),
}


@dataclass(frozen=True)
class Source:
    """One dataset: where its files are, and where else if they cannot be read."""

    name: str
    disease: str
    path: str
    fallback: str | None = None


def with_lineage(df: DataFrame, path: str, at: datetime) -> DataFrame:
    return df.withColumns({"_source_url": F.lit(path), "_ingested_at": F.lit(at.isoformat())})


def _land_path(
    spark: SparkSession,
    store: RawStore,
    source: Source,
    path: str,
    at: datetime,
    copy: bool,
    primary_error: str | None = None,
) -> tuple:
    version = pointer.new_version(at)
    records, parsed = parse_text_csv(spark, path)
    landed = with_lineage(records, path, at)
    target = store.add(landed, source.name, version)
    rows = spark.read.parquet(target).count()
    if rows != parsed:
        raise RuntimeError(f"{parsed} records were parsed and {rows} landed")
    store.snapshot(spark, source.name, version, copy=copy)
    return (source.name, source.disease, rows, len(landed.columns), path, target, None, primary_error)


def land(
    spark: SparkSession, store: RawStore, source: Source, at: datetime, *, copy: bool = False
) -> tuple:
    """Land a source; its lineage names the path that was read. If that is the fallback, the
    report keeps the error of the primary path."""
    try:
        return _land_path(spark, store, source, source.path, at, copy)
    except FileExistsError:
        raise
    except Exception as failure:
        if source.fallback is None:
            raise
        return _land_path(spark, store, source, source.fallback, at, copy, str(failure))


def ingest(
    spark: SparkSession,
    store: RawStore,
    sources: Sequence[Source],
    at: datetime | None = None,
    *,
    copy: bool = False,
) -> DataFrame:
    """Land all sources side by side; a failing one does not stop the others.

    Returns one row per source. Those that failed have their `error` set. `copy` gives
    each snapshot files of its own. Sources of one name are landed one after the other.
    """
    at = at or datetime.now(timezone.utc)

    def landed(source: Source) -> tuple:
        try:
            return land(spark, store, source, at, copy=copy)
        except Exception as failure:
            return (source.name, source.disease, None, None, None, None, str(failure), None)

    def landed_in_turn(places: list[int]) -> dict[int, tuple]:
        return {place: landed(sources[place]) for place in places}

    by_name: dict[str, list[int]] = {}
    for place, source in enumerate(sources):
        by_name.setdefault(source.name, []).append(place)
    jobs = {name: partial(landed_in_turn, places) for name, places in by_name.items()}
    done = {k: row for rows in run_together(jobs, SIDE_BY_SIDE).values() for k, row in rows.items()}
    return spark.createDataFrame([done[place] for place in sorted(done)], REPORT)


def exit_code(report: DataFrame) -> int:
    """1 if any source failed."""
    return 0 if report.where("error IS NOT NULL").isEmpty() else 1
