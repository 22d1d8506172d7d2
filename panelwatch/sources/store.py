"""Raw datasets at rest: every ingested version, and a snapshot of the latest."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.sources import pointer
from panelwatch.sources.files import child_folders, exists

VERSION = "ingest_ts"
SCHEMAS = "name string, version string, schema string"


@dataclass(frozen=True)
class RawStore:
    """`root/raw/<dataset>/ingest_ts=<version>` and `root/snapshot`."""

    root: str

    def history_path(self, dataset: str) -> str:
        return f"{self.root}/raw/{dataset}"

    def version_path(self, dataset: str, version: str) -> str:
        return f"{self.history_path(dataset)}/{VERSION}={version}"

    @property
    def snapshot_log(self) -> str:
        return f"{self.root}/snapshot/log"

    @property
    def schema_log(self) -> str:
        return f"{self.root}/schemas"

    def add(self, df: DataFrame, dataset: str, version: str) -> str:
        """Write one version. One that is complete is never written again; what a failed write left is."""
        path = self.version_path(dataset, version)
        if self._complete(df.sparkSession, path):
            raise FileExistsError(f"{dataset} has a version {version} already")
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        pointer.add(df.sparkSession, self.schema_log, SCHEMAS, (dataset, version, df.schema.json()))
        return path

    def snapshot(self, spark: SparkSession, dataset: str, version: str, *, copy: bool = False) -> str:
        """Make a version the stable latest one.

        The snapshot is the version itself, named in the log. With `copy` it gets files
        of its own, for a history that is cleared.
        """
        path = self.version_path(dataset, version)
        if copy:
            latest = spark.read.parquet(path)
            path = f"{self.root}/snapshot/{dataset}/{version}"
            latest.write.mode("overwrite").option("compression", "snappy").parquet(path)
        pointer.publish(spark, self.snapshot_log, dataset, version, path)
        return path

    @staticmethod
    def _complete(spark: SparkSession, path: str) -> bool:
        return exists(spark, f"{path}/_SUCCESS")

    def versions(self, spark: SparkSession, dataset: str) -> list[str]:
        """The versions there are, oldest first, from the names of their folders alone."""
        marker = f"{VERSION}="
        folders = child_folders(spark, self.history_path(dataset))
        return sorted(f.removeprefix(marker) for f in folders if f.startswith(marker))

    def schemas(self, spark: SparkSession, dataset: str) -> dict[str, T.StructType]:
        """The schema of every complete version, oldest first, from the log that is written with each.

        Only a version from before there was a log is asked itself: for the footer of one of its files.
        """
        logged = pointer.entries(spark, self.schema_log, SCHEMAS)
        rows = [] if logged is None else logged.where(F.col("name") == dataset).collect()
        known = {r["version"]: T.StructType.fromJson(json.loads(r["schema"])) for r in rows}
        found = {}
        for version in self.versions(spark, dataset):
            if version in known:
                found[version] = known[version]
            elif self._complete(spark, self.version_path(dataset, version)):
                found[version] = spark.read.parquet(self.version_path(dataset, version)).schema
        return found

    def history(self, spark: SparkSession, dataset: str) -> DataFrame:
        """All complete versions, told apart by `ingest_ts`. Text columns that a version lacks are ''.

        Columns are in the order in which versions brought them. Their types come from the log of schemas, so
        no file is opened to plan a read; a column whose type changed is an error.
        """
        schemas = self.schemas(spark, dataset)
        if not schemas:
            raise FileNotFoundError(f"no ingested version of {dataset}")
        merged: dict[str, T.StructField] = {}
        for version, schema in schemas.items():
            for field in schema:
                first = merged.setdefault(field.name, T.StructField(field.name, field.dataType))
                if first.dataType != field.dataType:
                    raise ValueError(f"{field.name} of {dataset} is {field.dataType} in {version}, {first.dataType} before")
        declared = T.StructType([*merged.values(), T.StructField(VERSION, T.StringType())])
        paths = [self.version_path(dataset, v) for v in schemas]
        rows = spark.read.schema(declared).option("basePath", self.history_path(dataset)).parquet(*paths)
        texts = [f.name for f in merged.values() if f.dataType == T.StringType()]
        return rows.withColumns({c: F.coalesce(f"`{c}`", F.lit("")) for c in texts})

    def newest_version(self, spark: SparkSession, dataset: str) -> str | None:
        """The newest complete version, from the names of the version folders alone."""
        versions = reversed(self.versions(spark, dataset))
        return next((v for v in versions if self._complete(spark, self.version_path(dataset, v))), None)

    def latest(self, spark: SparkSession, dataset: str) -> DataFrame:
        """The snapshot, else the newest version, else an error. Never several versions."""
        path = pointer.current(spark, self.snapshot_log, dataset)
        if path is None:
            version = self.newest_version(spark, dataset)
            if version is None:
                raise FileNotFoundError(f"no snapshot and no ingested version of {dataset}")
            path = self.version_path(dataset, version)
        return spark.read.parquet(path)
