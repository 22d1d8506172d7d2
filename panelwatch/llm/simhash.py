"""Operator 8: near-duplicate classes by SimHash and multi-index hashing.

A text's words are lower-cased (A-Z) and hashed in shingles of three; a fingerprint bit is set if it is set
in over half the shingles' hashes. Two fingerprints link at `radius` or fewer differing bits.

Fingerprints are first made distinct, so copies by the thousand are one row. A fingerprint of 64 bits is
cut into two segments, each with its own table. Two fingerprints within the radius differ by at most half
of it in one segment at least, so each fingerprint enumerates the Hamming balls of that small radius
around its segments, fetches the tables' matches, and the complete distance is verified.

A table entry with very many fingerprints (`crowd`) would give all pairs within it, so whoever meets one is
matched another way, just as exactly: fingerprints within distance 2 are those whose balls of radius 1 over
all 64 bits share a value, and a value is shared by 65 distinct fingerprints at most. Each is linked to the
least of them. No pair is lost and none is emitted that isn't needed for the components.

Defined cases: a text without words (null, empty) has fingerprint zero, linked like any other; rows with a
null doc_id take part, and their component is named by the least doc_id that isn't null, if any; equal rows
are rows of their own; an empty table gives no rows; long texts are hashed in pieces of fixed size; extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.llm.common import fresh, run_anywhere, with_row_key
from panelwatch.llm.graph import components
from panelwatch.session import materialise

run_anywhere(__name__)

SHINGLE = 3
SEED = 42
RADIUS = 2
CROWD = 64
_PIECE = 1 << 15


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of a text, as an unsigned number."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and \x20 and \x09 to \x0d.
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    size = min(size, len(words))
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for s in range(0, n, _PIECE):
        part = words[s : s + _PIECE + size - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        hashes = np.fromiter((digest(g, SEED) for g in grams), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def simhash(texts: pa.Array) -> pa.Array:
    """The fingerprints of a column of texts; the 64 bits as a signed number."""
    prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
    return pa.array(prints.view(np.int64))


def _segment(value: Column, table: int) -> Column:
    return F.shiftrightunsigned(value, 32 * table).bitwiseAND(F.lit(0xFFFFFFFF))


def _ball(value: Column, bits: int) -> Column:
    """All values at one or no differing bit, as an array."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
    return F.concat(F.array(value), flips)


def _entries(prints: DataFrame, values) -> DataFrame:
    """fp with table and segment value, for each value that `values` makes of a segment."""
    fp = F.col("fp")
    tables = F.array(*[F.struct(F.lit(t).alias("table"), values(_segment(fp, t)).alias("keys")) for t in (0, 1)])
    one = prints.select("fp", F.explode(tables).alias("_t"))
    return one.select("fp", F.col("_t.table").alias("table"), F.explode("_t.keys").alias("key"))


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all those at distance 2 or less."""
    index = _entries(prints, lambda s: F.array(s))
    probes = _entries(prints, lambda s: _ball(s, 32))
    crowded = materialise(index.groupBy("table", "key").count().where(F.col("count") > crowd).select("table", "key"), "crowded")
    met = probes.join(index.withColumnRenamed("fp", "v").join(crowded, ["table", "key"], "left_anti"), ["table", "key"])
    near = met.where((F.col("fp") < F.col("v")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= RADIUS))
    edges = near.select(F.col("fp").alias("u"), "v")
    if crowded.isEmpty():
        return edges
    meeting = probes.join(crowded, ["table", "key"], "left_semi").select("fp").distinct()
    shared = meeting.select("fp", F.explode(_ball(F.col("fp"), 64)).alias("value"))
    sets = shared.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = sets.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u != v")
    return edges.unionAll(stars)


def classes(docs: DataFrame, keep: Column | None = None) -> DataFrame:
    """One row per document: doc_id, fp, component (the least doc_id of its class).

    `keep` is a further column to carry along, such as a row's key.
    """
    carried = [] if keep is None else [keep]
    marked = materialise(docs.select("doc_id", simhash("text").alias("fp"), *carried), "fingerprints")
    names = [c for c in marked.columns if c not in ("doc_id", "fp")]
    prints = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    roots = components(links(prints.select("fp")))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component")), "components")
    named = rooted.join(least, "root").select("fp", "root", "component")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component", *names)


def representatives(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each class the row with the least doc_id (by place in
    its file among equal ones), all columns as they are."""
    row = fresh(docs, "_row")
    keyed = with_row_key(docs, row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("row"))
    grouped = classes(keyed, F.col(row)).groupBy("root").agg(F.min(order).alias("first"))
    return keyed.join(grouped.select(F.col("first.row").alias(row)), row, "left_semi").drop(row)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))
