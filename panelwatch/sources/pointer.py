"""Which version of a dataset is the current one.

A version is written to a path of its own, and then published by adding one row, in a folder of its
own, to a small log. Readers follow the newest row, so they never see a half-written version, and a failed
write leaves the one before in place. Writers that publish at the same time do not meet.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "name string, version string, path string"


def new_version(at: datetime | None = None) -> str:
    """Versions sort by time as text."""
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S%fZ")


def publish(spark: SparkSession, log: str, name: str, version: str, path: str) -> None:
    add(spark, log, LOG, (name, version, path))


def add(spark: SparkSession, log: str, schema: str, row: tuple) -> None:
    """Add a row to a log."""
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{log}/{uuid.uuid4().hex}")


def entries(spark: SparkSession, log: str, schema: str) -> DataFrame | None:
    """All rows of a log, or None if there is no log."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(log)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, log: str, name: str) -> str | None:
    """The path published last under a name, or None."""
    rows = entries(spark, log, LOG)
    if rows is None:
        return None
    return rows.where(F.col("name") == name).agg(F.max_by("path", "version")).first()[0]
