"""Operator 7: exact top-k search by inner product with MaxScore.

Each dimension is a term whose postings are the components of all vectors of a shard, kept column by
column. For a query, a term's bound is the most it can add to any score of the shard. With the k-th best
score so far as threshold, the weakest terms whose bounds together stay below it are non-essential: a row
that has only their postings cannot be among the best. The essential terms' postings are traversed. Rows whose partial score plus the bounds left still reaches the threshold are
probed in the other terms, a few at a time, and dropped as soon as they are no longer competitive. Signed
components are no obstacle, as bounds are taken per query from each term's least and largest value.
Scores are exact integers, and a row is dropped only if it is below the threshold, never on a tie.

Equal query rows are one query. Queries are taken in blocks of fixed size, by a hash of id and vector, so what is broadcast doesn't grow; each block scans all rows
once. Each task keeps k rows per query of its shards, and one window per query merges the tasks' rows.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; shorter vectors
count as filled up with zeros; rows that share a query's vec_id are its own and no candidates; a null
vec_id is a candidate that comes last among ties (as the largest number) and is returned as null; repeated
query rows are queries of their own; an empty table gives no rows; extra columns are not looked at. Scores
are exact whole numbers up to 64 bits; beyond these they are out of range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwatch.llm.common import run_anywhere
from panelwatch.session import materialise, scratch_path

run_anywhere(__name__)

K = 5
BLOCK = 2048
_NONE = np.iinfo(np.int64).max
_EXACT = float(1 << 53)
_PROBE = 8  # terms probed at a time
_FIRST = 256  # rows scored in full for a first threshold


def quantised(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 * x) as a matrix of whole numbers, and the rows it is made of."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    length = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(length)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    whole = ~vectors.is_null().to_numpy(zero_copy_only=False) & (bad[begin[1:]] == bad[begin[:-1]])
    rows = np.flatnonzero(whole)
    matrix = np.zeros((len(rows), int(length[rows].max(initial=0))))
    at = np.arange(matrix.shape[1])
    inside = at < length[rows, None]
    matrix[inside] = np.floor(256 * values[(begin[rows, None] + at)[inside]])
    return matrix, rows


class Best:
    """The k best (score, id) of one query so far, by score and then by smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> float:
        return self.score[-1] if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        # Scores are whole numbers; where they are held as doubles, these are exact.
        score, ids = np.concatenate([self.score, score.astype(np.int64)]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[order], ids[order]


def search(postings: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, best: Best) -> None:
    """MaxScore over one shard: `postings` has a row for each term."""
    high, low = postings.max(axis=1), postings.min(axis=1)
    bound = np.maximum(query * high, query * low)
    least = np.maximum(bound, 0)  # a component of zero adds nothing, as if the row were not in the postings
    order = np.argsort(-least, kind="stable")
    left = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # the most that terms from here on add
    rest = np.concatenate([np.cumsum(least[order][::-1])[::-1], [0]])
    others = np.flatnonzero(ids != own)
    if best.threshold == -np.inf and len(others):
        head, others = others[:_FIRST], others[_FIRST:]
        best.add(query @ postings[:, head], ids[head])
    if not len(others):
        return
    # Essential: the strongest terms, until a row in the postings of the others alone stays below the threshold.
    essential = int(np.argmax(rest < best.threshold)) if rest[-1] < best.threshold else len(order)
    first = order[:essential]
    score = query[first] @ postings[first][:, others]
    for s in range(essential, len(order) + _PROBE, _PROBE):
        alive = score + left[min(s, len(order))] >= best.threshold
        others, score = others[alive], score[alive]
        if s >= len(order) or not len(others):
            break
        more = order[s : s + _PROBE]
        score = score + query[more] @ postings[np.ix_(more, others)]
    best.add(score, ids[others])


def _searcher(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, times, queries = shared.value
        best = [Best(k) for _ in own]
        for batch in batches:
            matrix, rows = quantised(batch.column("vector"))
            if not len(rows):
                continue
            ids = batch.column("id").fill_null(_NONE).to_numpy(zero_copy_only=False)[rows]
            terms = max(matrix.shape[1], queries.shape[1])
            postings = np.zeros((terms, len(rows)))
            postings[: matrix.shape[1]] = matrix.T
            asked = np.pad(queries, ((0, 0), (0, terms - queries.shape[1])))
            if np.abs(asked).max(axis=0, initial=0) @ np.abs(postings).max(axis=1, initial=0) >= _EXACT:
                asked, postings = asked.astype(np.int64), postings.astype(np.int64)
            for q in range(len(own)):
                search(postings, ids, asked[q], own[q], best[q])
        for q, found in enumerate(best):
            if len(found.id):
                n = len(found.id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, q, np.int32)), pa.array(np.full(n, times[q])), pa.array(np.full(n, own[q])),
                     pa.array(found.id, mask=found.id == _NONE), pa.array(found.score.astype(np.int64))],
                    names=["q", "times", "query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    table = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vector"))
    asked = vectors.where(is_query).select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vector"))
    # Equal query rows are asked once.
    asked = materialise(asked.groupBy("id", "vector").agg(F.count("*").alias("times")), "queries")
    blocks = max(1, -(-asked.count() // block))
    path = scratch_path(spark, "best")
    schema = "q int, times bigint, query_id bigint, vec_id bigint, score bigint"
    merged = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == b).orderBy("id", "vector").toArrow()
        queries, rows = quantised(own.column("vector"))
        ids, times = (own.column(c).to_numpy()[rows] for c in ("id", "times"))
        shared = spark.sparkContext.broadcast((ids, times, queries))
        found = table.mapInArrow(_searcher(shared, k), schema)
        ranked = found.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)
        repeated = ranked.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times"))))
        repeated.select("query_id", "rank", "vec_id", "score").write.parquet(f"{path}/{b}")
        shared.destroy()
    return spark.read.schema("query_id bigint, rank int, vec_id bigint, score bigint").parquet(
        *[f"{path}/{b}" for b in range(blocks)]
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
