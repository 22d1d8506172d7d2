"""Session settings and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from panelwatch.sources.files import delete_at_end

T = TypeVar("T")

_LOCAL_DIRS: dict[str, str] = {}
_MARKED: set[str] = set()


def local_session(cpus: int = 8, app: str = "panelwatch", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the session comes from the submit command; nothing in the library
    depends on the settings made here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording the call site of every expression costs more than planning a build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster that folder
    would be a different one on each machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="panelwatch-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a folder of the session that is deleted as its process ends."""
    root = f"{shared_dir(spark)}/panelwatch/{spark.sparkContext.applicationId}"
    if root not in _MARKED:
        delete_at_end(spark, root)
        _MARKED.add(root)
    return f"{root}/{uuid.uuid4().hex}/{label}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    This cuts the lineage for good (a lost executor re-reads files instead of
    recomputing), and gives Spark the file sizes on which it picks join strategies.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_together(jobs: Mapping[str, Callable[[], T]], at_once: int | None = None) -> dict[str, T]:
    """Submit independent jobs at once, or so many of them, so that the tail of one does not idle the cluster.
    The first failure is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), at_once or len(jobs)))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
