"""Operator 10: shuffle documents into shards by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets of about `bucket_bytes`, all columns counted, by a seeded
hash of the row's place in its file. Pass two gathers each bucket in one task, puts it into a fixed order, permutes it by
Spark's `shuffle` (a Fisher-Yates shuffle) and writes it. Bucket after bucket this is one random order of
all rows; shard k is its k-th part, so shard counts differ by one at most (law `rows`). Every bucket is
about equally large whatever its rows hold, also if most texts or doc_ids are equal.

The bucket of a row depends on the seed and the row's place alone, and bucket b is partition b, so a task
that runs again after the loss of an executor makes the same rows in the same order.

Defined cases: a null text has no bytes; nulls, repeated rows and equal texts are rows like any others; an
empty table gives empty shards (no rows); extra columns are kept, however wide, except those named like
`shard` or `slot`. A row longer than a bucket makes that bucket as much larger. As a row is known by its
place, a copy of the table in other files is dealt anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.llm.common import fresh, unpacked, with_row_key, without
from panelwatch.session import scratch_path

SHARDS = 16
BUCKET_BYTES = 32 << 20
SEED = 20


def size_of(text: Column) -> Column:
    """Bytes of a text plus one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def width_of(df: DataFrame) -> Column:
    """Bytes of a row: those of its texts, those of nested values as JSON, and eight for each column."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            width += F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return width.cast("long")


def shuffled(
    docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """The documents with `shard` (0 to shards - 1) and `slot` (0, 1, ... in each shard)."""
    docs = without(docs, ["shard", "slot"])
    row = fresh(docs, "_row")
    total, n = docs.agg(F.sum(width_of(docs)), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))

    keyed = with_row_key(docs, row)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    place = F.xxhash64(F.lit(seed), F.col(row)["file"], F.col(row)["row"])
    scattered = keyed.select(
        whole.alias("doc"),
        F.col(row).alias("row"),
        place.alias("place"),
        F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"),
    )
    # One row per bucket, combined before the shuffle: the rows before each bucket.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        scattered.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    gathered = (
        scattered.repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("place", "row")
        .groupBy("bucket")
        .agg(F.collect_list("doc").alias("docs"))
    )
    # As many rows of two numbers as there are buckets, each of which stands for `bucket_bytes` of text.
    permuted = gathered.join(F.broadcast(first), "bucket").select(
        F.posexplode(F.shuffle("docs", seed)).alias("at", "doc"), "first"
    )
    placed = permuted.withColumn("position", F.col("first") + F.col("at"))
    shard = F.expr(f"(position * {shards}L) div {max(1, n)}L")
    start = F.expr(f"(((position * {shards}L) div {max(1, n)}L) * {n}L + {shards - 1}L) div {shards}L")
    return unpacked(placed, "doc", shard.cast("int").alias("shard"), (F.col("position") - start).alias("slot"))


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the shards as one folder each, in slot order, and return them as read back."""
    ready = shuffled(docs, **options).sortWithinPartitions("shard", "slot")
    ready.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(ready.schema).parquet(path)


def op10_shard_documents(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    written = write_shards(docs, scratch_path(spark, "shards"))
    return written.select(
        "doc_id",
        size_of(F.col("text")).alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
