"""Operator 5: find documents that hold benchmark items, by SimHash over item-sized windows.

Words are maximal runs of letters, marks and digits, lower-cased; shingles have five words (an item with
fewer words is one shingle), and their weight is how often they occur.

1. Places. A window as similar to an item as asked for holds so many of its shingles, at any place and in any
   order. The shingle table of the benchmark is looked up (broadcast if its row count is proven small, else
   joined with hot keys split); all other places are dropped in the same stage, before anything moves. For
   each text and item, the places then tell all starts of stretches that hold enough of them.
2. SimHash. Each window so placed is cut to the item's size and fingerprinted in 64 bits.
3. Multi-index blocks. The 64 bits are cut into radius + 1 blocks. Fingerprints within the radius are
   equal in one block at least, so looking up (size, block, value) finds all items within the radius.
   The radius is wide: at similarity 0.8 about 9 bits differ, with a deviation of 3.
4. Verification. Candidates within the radius are compared exactly: weighted Jaccard of the shingles.

All stages work on whole texts, once per distinct text. Everything is DataFrame functions.

Defined cases: null and empty texts, and items without words, match nothing; equal texts have equal
results; of windows with equal similarity the least item id is reported, a null id last;
an item with a null id is an item like any other, reported as null; documents shorter than an item
are compared as a whole; an empty benchmark or table gives clean documents or no rows; extra columns are
kept by `clean` and not looked at otherwise; rows with null doc_id are judged as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm.common import fresh, small_lists
from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 20
BITS = 64


def words(text: Column) -> Column:
    """The lower-cased words of a text as an array."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _starts(ws: Column, k: Column) -> Column:
    # Where shingles of k words begin, from 1.
    return F.when((F.size(ws) >= k) & (k > 0), F.sequence(F.lit(1), F.size(ws) - k + 1)).otherwise(
        F.array().cast("array<int>")
    )


def shingles(ws: Column) -> Column:
    """The shingles of an array of words, as texts with repeats."""
    k = F.least(F.lit(SHINGLE), F.size(ws))
    return F.transform(_starts(ws, k), lambda i: F.concat_ws(" ", F.slice(ws, i, k)))


def _hashed(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def _hashes(hashed: Column, k: int) -> Column:
    """Hashes of all shingles of k words, from the words' own hashes."""
    first = F.slice(hashed, F.lit(1), F.greatest(F.size(hashed) - F.lit(k - 1), F.lit(0)))
    return F.transform(first, lambda h, i: F.xxhash64(h, *[F.get(hashed, i + n) for n in range(1, k)]))


def simhash(grams: Column) -> Column:
    """The bits that are set in over half of the shingles' hashes."""
    hashes = F.transform(grams, lambda g: F.xxhash64(g))

    def set_in(bit: Column) -> Column:
        one = lambda h: F.call_function("shiftright", h, bit).bitwiseAND(F.lit(1).cast("bigint"))
        ones = F.aggregate(hashes, F.lit(0).cast("bigint"), lambda s, h: s + one(h))
        return F.when(2 * ones > F.size(hashes), F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    places = F.sequence(F.lit(0), F.lit(BITS - 1))
    return F.aggregate(
        places, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", set_in(b), b))
    )


def _blocks(fp: Column, radius: int) -> Column:
    """block and value of each of the radius + 1 blocks of a fingerprint."""
    edges = [BITS * b // (radius + 1) for b in range(radius + 2)]
    cut = [
        F.struct(
            F.lit(b).alias("block"),
            F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint")).alias("value"),
        )
        for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return F.explode(F.array(*cut))


def _counted(grams: Column) -> Column:
    # Repeats become different: the n-th occurrence of a shingle carries its n.
    ordered = F.array_sort(grams)
    return F.transform(ordered, lambda g, i: F.concat_ws("#", (i - F.array_position(ordered, g)).cast("string"), g))


def similarity(one: Column, other: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles with repeats."""
    shared = F.size(F.array_intersect(_counted(one), _counted(other)))
    return shared / (F.size(one) + F.size(other) - shared)


def _placed(at: Column, needed: Column, length: Column, last: Column) -> Column:
    """All starts from 0 to `last` of stretches of `length` shingles with `needed` or more of the places `at`."""
    # The first place in a stretch is the i-th; then its needed-th is the last that has to lie in it.
    def starts(i: Column) -> Column:
        before = F.when(i > 0, F.get(at, i - 1) + 1).otherwise(0)
        low = F.greatest(before, F.get(at, i + needed - 1) - length + 1)
        high = F.least(F.get(at, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.sequence(F.lit(0), F.size(at) - needed)
    return F.when(F.size(at) >= needed, F.flatten(F.transform(firsts, starts))).otherwise(F.array().cast("array<int>"))


def windows(docs: DataFrame, items: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """key (of the text), size, start, window: the item-sized windows that may be similar to an item."""
    met = None
    sizes = [r[0] for r in items.select("k").distinct().collect()]  # at most SHINGLE numbers
    cut = docs.select(F.md5("text").alias("key"), words(F.col("text")).alias("ws"))
    cut = cut.select("key", F.size("ws").alias("n"), _hashed(F.col("ws")).alias("hashed"))
    for k in sorted(sizes):
        hashed = items.where(F.col("k") == k).select("size", "item_id", _hashed(F.col("ws")).alias("hashed"))
        grams = hashed.select("size", "item_id", F.explode(_hashes(F.col("hashed"), k)).alias("gram"))
        table = materialise(
            grams.distinct().groupBy("gram").agg(F.collect_set(F.struct("size", "item_id")).alias("items")), "item_shingles"
        )
        places = cut.select("key", "n", F.posexplode(_hashes(F.col("hashed"), k)).alias("pos", "gram"))
        found = lookup(places, table, ["gram"], small=small_lists(table, "items"), salt_by=["pos", "gram"])
        found = found.select("key", "n", F.lit(k).alias("k"), "pos", F.explode("items").alias("i"))
        met = found if met is None else met.unionByName(found)
    by_item = met.groupBy("key", "n", "k", "i").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    # The shingles of the window, which is the whole text if that is shorter, and of the item.
    length = F.least(F.col("i.size"), F.col("n")) - F.col("k") + 1
    of_item = F.col("i.size") - F.col("k") + 1
    needed = F.ceil(F.lit(similar / (1 + similar)) * (length + of_item) - F.lit(1e-6)).cast("int")
    last = F.greatest(F.lit(0), F.col("n") - F.col("i.size"))
    starts = by_item.select("key", F.col("i.size").alias("size"), F.explode(_placed(F.col("at"), F.greatest(F.lit(1), needed), length, last)).alias("start"))
    placed = materialise(starts.groupBy("key").agg(F.collect_set(F.struct("size", "start")).alias("places")), "places")
    texts = docs.select(F.md5("text").alias("key"), "text")
    opened = lookup(texts, placed, ["key"], small=small_lists(placed, "places"))
    place = opened.select("key", words(F.col("text")).alias("ws"), F.explode("places").alias("p"))
    window = F.concat_ws(" ", F.slice(F.col("ws"), F.col("p.start") + 1, F.col("p.size")))
    return place.select("key", "p.size", "p.start", window.alias("window")).distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR, radius: int = RADIUS
) -> DataFrame:
    """One row per distinct contaminated text: key (its MD5), n_items, item_id, similarity (of the best)."""
    ws = words(F.col("text"))
    items = materialise(
        benchmark.where("text IS NOT NULL")
        # Items without an id are told apart by their texts.
        .select(
            F.struct(
                F.col("item_id").isNotNull().alias("named"),
                F.col("item_id").cast("bigint").alias("id"),
                F.when(F.col("item_id").isNull(), F.md5("text")).alias("text"),
            ).alias("item_id"),
            ws.alias("ws"),
        )
        .where(F.size("ws") > 0)
        .select("item_id", "ws", F.size("ws").alias("size"), F.least(F.size("ws"), F.lit(SHINGLE)).alias("k")),
        "items",
    )
    if items.isEmpty():
        empty = "key string, n_items bigint, item_id bigint, similarity double"
        return docs.sparkSession.createDataFrame([], empty)
    known = items.select("item_id", "size", shingles(F.col("ws")).alias("item_grams"))
    known = materialise(known.withColumn("item_fp", simhash(F.col("item_grams"))), "item_fingerprints")
    block = _blocks(F.col("item_fp"), radius).alias("_b")
    index = (
        known.select("size", "item_id", "item_fp", block)
        .groupBy("size", F.col("_b.block").alias("block"), F.col("_b.value").alias("value"))
        .agg(F.collect_list(F.struct("item_id", "item_fp")).alias("items"))
    )
    placed = materialise(windows(docs, items, similar), "windows")
    printed = placed.withColumn("grams", shingles(F.split("window", " "))).withColumn("fp", simhash(F.col("grams")))
    probes = materialise(printed, "window_fingerprints").select(
        "key", "size", "start", "fp", "grams", _blocks(F.col("fp"), radius).alias("_b")
    )
    probes = probes.withColumns({"block": F.col("_b.block"), "value": F.col("_b.value")}).drop("_b")
    index = materialise(index, "item_blocks")
    met = lookup(probes, index, ["size", "block", "value"], small=small_lists(index, "items")).select(
        "key", "start", "block", "fp", "grams", F.explode("items").alias("i")
    )
    apart = F.col("fp").bitwiseXOR(F.col("i.item_fp"))
    # A pair is met in every block in which it is equal; the first of them counts.
    widths = [BITS * b // (radius + 1) for b in range(radius + 2)]
    earlier = F.lit(False)
    for b, (low, high) in enumerate(zip(widths, widths[1:], strict=False)):
        same = F.shiftrightunsigned(apart, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint")) == 0
        earlier = earlier | ((F.col("block") > b) & same)
    near = met.where((F.bit_count(apart) <= radius) & ~earlier).select(
        "key", F.col("i.item_id").alias("item_id"), "grams"
    )
    grams_of = known.select("item_id", "item_grams")
    verified = lookup(near, grams_of, ["item_id"], small=small_lists(grams_of, "item_grams")).select(
        "key", "item_id", similarity(F.col("grams"), F.col("item_grams")).alias("similarity")
    )
    best = F.max(F.struct("similarity", "item_id.named", (-F.col("item_id.id")).alias("item_id"))).alias("_best")
    return (
        verified.where(F.col("similarity") >= similar)
        .groupBy("key", "item_id")
        .agg(F.max("similarity").alias("similarity"))
        .groupBy("key")
        .agg(F.count("*").alias("n_items"), best)
        .select("key", "n_items", (-F.col("_best.item_id")).alias("item_id"), F.col("_best.similarity").alias("similarity"))
    )


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id and similarity of the best item."""
    found = materialise(contaminated(docs, benchmark, **options), "contaminated")
    judged = docs.select("doc_id", F.md5("text").alias("key")).join(found, "key", "left")
    return judged.select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        "item_id",
        "similarity",
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are."""
    key = fresh(docs, "_key")
    found = materialise(contaminated(docs, benchmark, **options).select(F.col("key").alias(key)), "contaminated")
    return docs.withColumn(key, F.md5("text")).join(found, key, "left_anti").drop(key)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return report(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
