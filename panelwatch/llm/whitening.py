"""Operator 13: whiten embeddings by their leading principal components.

Every component c of a vector becomes the whole number floor(256 c). The fit list has each distinct vector
once; copies, however many, are combined before they are shuffled. Two passes over it make the covariance:
sums per dimension, kept as whole numbers, then products of what is left after the mean is taken off. Each
task adds up one matrix and sends it row by row; the rows are added per dimension, and only the matrix
itself (`MAX_DIMENSIONS` squared at most) comes to the driver. Its leading eigenpairs are found there
(`eigen.py`), and projections, one small matrix, are broadcast to a scan of all rows.

Defined cases: vectors that are null, or hold null or non-finite components, are left out; if lengths
differ, shorter vectors are filled up with zeros; numbers beyond 64 bits count as the largest of them;
a null vec_id is returned as null; equal rows are rows of their own, one vector in the fit list; components without
variance, up to rounding, cannot be scaled and are left out, so identical vectors, vectors without
components and an empty table give no rows; a deviation beyond 64 bits is null; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import eigen
from panelwatch.llm.common import run_anywhere
from panelwatch.session import materialise

run_anywhere(__name__)

COMPONENTS = 4
STEPS = 256
MAX_DIMENSIONS = 4096
_LOW = (1 << 32) - 1
_SAFE = 1 << 62


def whole(vector: str | Column) -> Column:
    """floor(256 c) of every component, or null for a vector that takes no part."""
    column = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(column, lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")).cast("bigint")))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def fit_list(numbers: DataFrame) -> tuple[DataFrame, int, int]:
    """The distinct vectors `x`, their number, and their dimensions."""
    fit = materialise(numbers.select("x").distinct(), "fit_list")
    n, least, most = fit.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if n and least < most:
        fit = materialise(fit.select(_filled(most).alias("x")).distinct(), "filled_fit_list")
        n = fit.count()
    return fit, n, most or 0


def _filled(dimensions: int) -> Column:
    return F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dimensions) - F.size("x")))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sums of the numbers' upper and lower halves, which cannot overflow."""
    high = low = None
    for batch in batches:
        x = _matrix(batch.column(0))
        parts = (x >> 32).sum(axis=0), (x & _LOW).sum(axis=0)
        high, low = parts if high is None else (high + parts[0], low + parts[1])
    if high is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int32()), pa.array(high), pa.array(low)], ["at", "high", "low"])


def sums(fit: DataFrame) -> list[int]:
    """The sum of every dimension, exactly."""
    parts = fit.mapInArrow(_sums, "at int, high bigint, low bigint").groupBy("at")
    total = parts.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    return [(int(r.high) << 32) + int(r.low) for r in total.orderBy("at").collect()]


@dataclass(frozen=True)
class Centre:
    """The mean as whole numbers and what is left of it, so that nothing is lost when it is taken off."""

    n: int
    sums: tuple[int, ...]

    def off(self, x: np.ndarray) -> np.ndarray:
        floors = [s // self.n for s in self.sums]
        rest = np.array([(s - f * self.n) / self.n for s, f in zip(self.sums, floors, strict=True)])
        floors = np.array(floors)
        if max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))), int(np.abs(floors).max(initial=0))) >= _SAFE:
            return x.astype(float) - floors - rest
        return (x - floors).astype(float) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - sum) squared for each row, exactly; None beyond 64 bits."""
        bound = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if len(self.sums) * bound * bound < 1 << 63:
            return ((self.n * x - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1).tolist()
        return [d if d < 1 << 63 else None for d in exact]


def _products(make: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = make(_matrix(batch.column(0)))
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            rows = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), rows], ["at", "row"])

    return run


def products(fit: DataFrame, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Z'Z, where Z is what `make` makes of the fit list's rows.

    There is one matrix per task, and at most twice as many tasks as the cluster runs at once, so the rows
    that are added up per dimension are few. They are sorted first: the sum doesn't depend on their order.
    """
    tasks = 2 * fit.sparkSession.sparkContext.defaultParallelism
    parts = fit.coalesce(tasks).mapInArrow(_products(make), "at int, row array<double>")
    rows = F.sort_array(F.collect_list("row"))
    added = F.reduce(F.slice(rows, F.lit(2), F.lit(tasks)), F.get(rows, F.lit(0)), lambda a, b: F.zip_with(a, b, lambda p, q: p + q))
    total = parts.groupBy("at").agg(added.alias("row")).orderBy("at").toArrow()
    return np.array(total["row"].to_pylist(), float)


@dataclass(frozen=True)
class Whitening:
    """What was fitted: the centre, unit components as columns, their eigenvalues, and the trace."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.off(x) @ (self.components / np.sqrt(self.values))


def fitted(fit: DataFrame, n: int, dimensions: int, k: int = COMPONENTS) -> Whitening | None:
    """The whitening by the k leading components of a fit list; None if nothing varies."""
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"{dimensions} dimensions; a covariance on the driver has at most {MAX_DIMENSIONS}")
    if not n or not dimensions:
        return None
    centre = Centre(n, tuple(sums(fit)))
    covariance = products(fit, centre.off) / n
    values, vectors = eigen.leading(covariance, k)
    varies = values > dimensions * np.finfo(float).eps * max(values.max(), 0.0)
    if not varies.any():
        return None
    return Whitening(centre, vectors[:, varies], values[varies], float(np.trace(covariance)))


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    total = products(fit, lambda x: np.column_stack([np.ones(len(x)), whitening.project(x)]))
    mean = total[0, 1:] / total[0, 0]
    covariance = total[1:, 1:] / total[0, 0] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    numbers = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole("embedding").alias("x")).where("x IS NOT NULL")
    fit, n, dimensions = fit_list(numbers)
    whitening = fitted(fit, n, dimensions, k)
    if whitening is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast((whitening, identity_error(fit, whitening)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, error = shared.value
        found = len(fit.values)
        for batch in batches:
            x = _matrix(batch.column("x"))
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), found))),
                    pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * found, fit.centre.n)),
                    pa.array([d for d in fit.centre.deviations(x) for _ in range(found)], pa.int64()),
                    pa.array(fit.project(x).ravel()),
                    pa.array(np.tile(fit.values / fit.trace, rows)),
                    pa.array(np.full(rows * found, error)),
                ],
                schema.replace(" bigint", "").replace(" int", "").replace(" double", "").split(", "),
            )

    return numbers.select("vec_id", _filled(dimensions).alias("x")).mapInArrow(project, schema)


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
