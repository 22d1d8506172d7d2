"""Small reports as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report as it was written."""
    return spark.read.schema(schema).json(path)


def write_json(report: DataFrame, path: str) -> None:
    """One JSON object per row, UTF-8 with text as it is."""
    report.coalesce(1).write.mode("overwrite").json(path)
