"""Operator 1: mix sources to target weights.

The words of each source are summed, every source gets a target, and its repetition rate is the target
divided by its words. A document is emitted floor(rate) times, plus once more if a draw seeded by its
doc_id falls below the rate's fraction. Sums are combined before the shuffle, so a source that holds most
rows costs no more than any other; the sources' targets are looked up by a join whose size is checked.

The first row of a doc_id is drawn by the id alone, any further one by the id and its number among the
rows of that id, in the order of source, size and contents. So a source of equal ids, or of null ids, comes
as near its target as any other. Ids are counted first, combined before the shuffle; only rows of repeated
ids are numbered, range by range and without their texts, so one id may hold a third of all rows.

Defined cases: a null text counts as empty; null is a source of its own, the last in order; a source
without words gets target 0 and rate 0; rows with equal doc_id (null too) are drawn one by one; an empty
table gives an empty result; extra columns are kept, except those named like the columns added here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import WORD, fresh, packed, unpacked, with_row_key, without, words_in
from panelwatch.operators.keys import number_rows
from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # all targets together, in parts of all words
MOST = 2.0  # a target, in parts of its source's words
SEED = "mix-1"
ADDED = ("size", "source_size", "target", "copies")


def draw(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys alone: 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _key(source: Column) -> Column:
    # Null becomes a key that sorts after every name.
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source))


def targets(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: `_key`, source_size, target.

    Targets are min(most * size, level * weight). The level starts where no source is capped and rises
    until the capped ones and the others make up the total; each step is one sum over the sources, and
    only its row comes to the driver. There are at most as many steps as sources, commonly two or three.
    """
    if not 0 <= share <= most:
        raise ValueError("share must lie between 0 and most, or the targets cannot be met")
    sums = docs.groupBy(_key(F.col("source")).alias("_key")).agg(F.sum(words_in(F.col("text"))).alias("source_size"))
    numbered = number_rows(materialise(sums, "source_sizes"), ["_key"], "_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(cycle, F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int"))
    sources = materialise(numbered.select("_key", "source_size", weight.alias("_weight")), "source_weights")

    room = F.lit(most) * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        full = room < F.lit(level) * F.col("_weight") if capped >= 0 else F.lit(False)
        total, used, free, n = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(full, room).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))),
            F.coalesce(F.count_if(full), F.lit(0)),
        ).first()
        if not total or n == capped or not free:
            break
        level, capped = (share * total - used) / free, n
    return sources.select("_key", "source_size", F.least(room, F.lit(level) * F.col("_weight")).alias("target"))


def _drawn(docs: DataFrame, seed: str) -> DataFrame:
    """All columns as `doc`, with size, _key and draw."""
    made = {"size": words_in(F.col("text")), "_key": _key(F.col("source"))}
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    counts = docs.groupBy(name.alias("_id")).agg(F.count("*").alias("_n"))
    again = materialise(counts.where("_n > 1").select("_id"), "repeated_ids")
    if again.isEmpty():
        return packed(docs, "doc", **made, draw=draw(seed, name))

    row = fresh(docs, "_row")
    keyed = with_row_key(docs, row)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = keyed.select(
        whole.alias("doc"),
        *[c.alias(n) for n, c in made.items()],
        name.alias("_id"),
        F.col(row)["file"].alias("_file"),
        F.col(row)["row"].alias("_at"),
    )
    order = ["_id", "_key", "size", "_same", "_file", "_at"]
    place = ["_file", "_at"]
    repeated = lookup(rows.withColumn("_same", F.xxhash64(F.to_json("doc"))).select(*order), again, ["_id"], salt_by=place)
    numbered = materialise(number_rows(materialise(repeated, "repeated_rows"), order, "_place"), "numbered_rows")
    firsts = materialise(numbered.groupBy("_id").agg(F.min("_place").alias("_first")), "first_rows")
    later = lookup(numbered, firsts, ["_id"], salt_by=place).where("_place > _first")
    nth = materialise(later.select(*place, (F.col("_place") - F.col("_first")).alias("_nth")), "later_rows")
    by_id, by_number = draw(seed, F.col("_id")), draw(seed, F.col("_id"), F.col("_nth"))
    drawn = F.when(F.col("_nth").isNull(), by_id).otherwise(by_number)
    return lookup(rows, nth, place, "left", salt_by=place).select("doc", *made, drawn.alias("draw"))


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The documents with size, source_size, target (of the source) and copies, the times to emit each."""
    docs = without(docs, ADDED)
    by_source = targets(docs, weights, share, most)
    joined = lookup(_drawn(docs, seed), by_source, ["_key"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("int")
    rated = joined.withColumn("rate", rate)
    return unpacked(rated, "doc", "size", "source_size", "target", copies.cast("int").alias("copies"))


def emit(planned: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as planned, with the documents' columns."""
    number = fresh(planned, "_copy")
    repeated = planned.where(F.col("copies") > 0).withColumn(number, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.drop(number, *ADDED)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    planned = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{WORD}')) END AS BIGINT) AS size
  FROM documents
), told AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN source IS NULL THEN 1 ELSE 0 END, encode(source), size) - 1 AS nth
  FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY CASE WHEN source IS NULL THEN 1 ELSE 0 END, encode(source)) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS place FROM sources
), levels AS (
  SELECT o.place,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - (SELECT coalesce(sum(2.0::DOUBLE * x.source_size), 0) FROM ordered x WHERE x.place < o.place))
      / (SELECT sum(x.weight) FROM ordered x WHERE x.place >= o.place) AS level,
    2.0::DOUBLE * o.source_size / o.weight AS ends
  FROM ordered o
), chosen AS (
  SELECT level FROM levels WHERE level <= ends ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT level FROM chosen) * weight) AS target FROM sources
), drawn AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST('0x' || md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null') || CASE WHEN s.nth > 0 THEN ':' || s.nth ELSE '' END)[1:13] AS BIGINT)::DOUBLE / 4503599627370496 AS u
  FROM told s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM drawn
"""
