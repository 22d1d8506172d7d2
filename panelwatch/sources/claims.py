"""Claims: of all who want to do a thing, in whatever process, one at a time does it.

A claim is a file that only one caller can create. Who holds it touches it every few seconds; a claim that was not touched
for long is that of a process that ended, and is taken away.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from threading import Event, Thread

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from panelwatch.sources import files

BEAT = 5.0
STALE = 120.0


@contextmanager
def holding(spark: SparkSession, path: str, *, beat: float = BEAT, stale: float = STALE) -> Iterator[None]:
    """Wait for a claim and hold it for the block; it is given up behind it, failed or not.

    Two who find the same claim stale at the same moment may both go on, so what is done under a claim must
    stay right if it is done twice.
    """
    while not files.create(spark, path):
        untouched = files.age(spark, path)
        if untouched is not None and untouched > stale:
            files.delete(spark, path)
        else:
            time.sleep(min(beat, 0.2))
    done = Event()

    def keep() -> None:
        while not done.wait(beat):
            # A beat that fails is made up for by the next one.
            with suppress(Py4JError):
                files.touch(spark, path)

    beats = Thread(target=keep, daemon=True)
    beats.start()
    try:
        yield
    finally:
        done.set()
        beats.join()
        files.delete(spark, path)
