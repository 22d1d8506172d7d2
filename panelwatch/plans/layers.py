"""Dense layers at rest: written once per build, bucketed by line and sorted by period.

A trend is a window over each line. On a layer bucketed by the line it needs no shuffle, and what reads
a layer does not fill the panel again. Partitions within keep what is asked of one disease to its files. A layer is an external table of the session's catalog, as Spark
keeps buckets there; other sessions declare it again from its folder, whose name tells the number of buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelwatch.plans import analytics
from panelwatch.sources.files import child_folders

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Layer:
    """What a layer holds, its columns, and how it is laid out."""

    make: Callable[[Tables], DataFrame]
    columns: str
    line: Sequence[str]
    period: str
    partition: str | None = None


LAYERS = {
    "weekly_dense": Layer(
        analytics.filled_weeks,
        "disease_code string, disease_name string, county_name string, iso_year int, iso_week int,"
        " week_start_date date, metric_value bigint, denominator bigint",
        ["disease_name", "county_name"],
        "week_start_date",
        "disease_code",
    ),
    "monthly_dense": Layer(
        analytics.filled_months,
        "county_name string, onset_year int, onset_month int, month_start date, cases bigint",
        ["county_name"],
        "month_start",
    ),
}


def _marker(name: str) -> str:
    return f"{name}-buckets-"


def _declared(spark: SparkSession, name: str, root: str, buckets: int) -> DataFrame:
    layer, path = LAYERS[name], f"{root}/{_marker(name)}{buckets}"
    table = declared_name(root, name, buckets)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({layer.columns}) USING parquet"
        + (f" PARTITIONED BY ({layer.partition})" if layer.partition else "")
        + f" CLUSTERED BY ({', '.join(layer.line)}) SORTED BY ({layer.period}) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    return spark.table(table)


def _in_order(layer: Layer, table: DataFrame) -> DataFrame:
    # A partition column is read last; the declared order is restored.
    return table.select(*[c.split()[0] for c in layer.columns.split(",")])


def write_layer(tables: Tables, root: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write a layer below `root`, each bucket by one task, and read it."""
    layer = LAYERS[name]
    df = layer.make(tables)
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    declared = _declared(spark, name, root, buckets)
    by_line = df.select(*declared.columns).repartition(buckets, *layer.line)
    by_line.write.insertInto(declared_name(root, name, buckets))
    spark.catalog.refreshTable(declared_name(root, name, buckets))
    return _in_order(layer, _declared(spark, name, root, buckets))


def declared_name(root: str, name: str, buckets: int) -> str:
    """The catalog's name of a layer."""
    return f"{name}_{hashlib.md5(f'{root}/{_marker(name)}{buckets}'.encode()).hexdigest()}"


def read_layers(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The layers of a build; builds that have none are read without."""
    found = {}
    for folder in child_folders(spark, root):
        for name in LAYERS:
            if folder.startswith(_marker(name)):
                buckets = int(folder.removeprefix(_marker(name)))
                layer, table = LAYERS[name], _declared(spark, name, root, buckets)
                # A catalog that keeps partitions does not know those that another session wrote.
                if layer.partition and spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true":
                    spark.catalog.recoverPartitions(declared_name(root, name, buckets))
                    table = spark.table(declared_name(root, name, buckets))
                found[name] = _in_order(layer, table)
    return found
