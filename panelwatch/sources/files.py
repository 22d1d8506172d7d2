"""What a folder holds, by the file system that Spark itself uses for its path."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, which may be missing. Nothing below them is listed."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory()]


def stamp(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of change of all that a folder holds itself."""
    files, place = _at(spark, path)
    entries = [(e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in files.listStatus(place)]
    return tuple(sorted(entries))


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless there is one; whether this call created it. Of several callers one does."""
    files, place = _at(spark, path)
    files.mkdirs(place.getParent())
    if files.getUri().getScheme() == "file":
        # The local file system of Hadoop looks first and creates then.
        return spark._jvm.java.io.File(place.toUri().getPath()).createNewFile()
    try:
        files.create(place, False).close()
    except Py4JJavaError as failure:
        if not files.exists(place):
            raise failure
        return False
    return True


def touch(spark: SparkSession, path: str) -> None:
    """Set a file's time of change to now."""
    files, place = _at(spark, path)
    files.setTimes(place, int(time.time() * 1000), -1)


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file's last change, or None if there is none."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return None
    return time.time() - files.getFileStatus(place).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    """Delete one file, if it is there."""
    files, place = _at(spark, path)
    files.delete(place, False)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the session's process ends."""
    files, place = _at(spark, path)
    files.deleteOnExit(place)
