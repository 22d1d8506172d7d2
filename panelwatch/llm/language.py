"""Operator 6: language identification by prediction by partial matching.

For each language a byte context tree of orders 4 to 0 (`order`) is counted on all labelled texts. With the
statistics frozen, the code length of a byte after its predecessors is a fixed number of bits:

* a byte seen n times in a context seen N times, with D different bytes, costs -log2(n / (N + D));
* any other byte costs the escape, -log2(D / (N + D)), and then what the next shorter context asks for;
* a context without a node passes on without cost, and a byte never seen at all costs 8 bits more.

A text's exact code length is the sum over its bytes. Each task looks up only the different byte strings of a
piece of its texts: a string's cost in every language is stored for each order at which the tree knows it, so the
longest known one gives the cost, and escapes of longer contexts are added. A text's language is the one with
the shortest code; the score is its share of the languages' probabilities for the text.

What is counted grows with the corpus: a row per language and byte string of up to order + 1 bytes, combined in each
task and then by Spark, in tables. What is broadcast does not: a context has a node if it was seen `least` times,
and `least` is the smallest power of two with which the tree has at most `cells` entries times languages. It
follows from the counts of all texts alone; it is 1, the whole tree, as long as that fits. A kept context keeps
all its statistics, so every code length is exact for the tree. Order 0 is always kept, which `cells` must hold:
beyond some 180 languages the default does not, and that is an error.

Defined cases: a null text, or one without any letter, is `und` with score 0, as is every text if nothing
was learned; empty and null texts and null languages teach nothing; languages with equal code length go to
the first by name; long texts are processed in pieces of fixed size; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwatch.llm.common import run_anywhere
from panelwatch.session import materialise

run_anywhere(__name__)

UNDETERMINED = "und"
ORDER = 4  # bytes of the longest contexts
CELLS = 1 << 23  # costs in a tree: entries times languages
_START = 0xFF  # stands before a text; never a byte of UTF-8
_UNSEEN = 8.0  # bits of a byte that no text had
_PIECE = 1 << 17
_ROWS = 1 << 10  # texts looked at together, at most
_HELD = 1 << 19  # different byte strings that a task counts before it passes them on


@dataclass(frozen=True)
class Level:
    """The contexts of one order: byte strings, the last byte of which follows the others."""

    strings: np.ndarray  # those known to any language, sorted, the last byte lowest
    cost: np.ndarray  # language x string: bits of the last byte, escapes included
    contexts: np.ndarray  # the strings without their last byte, sorted
    escape: np.ndarray  # language x context: bits of the escape, 0 without a node


@dataclass(frozen=True)
class Model:
    languages: list[str]  # in order of name
    levels: list[Level]  # by order, from 0


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (with the end of the last)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def _strings(data: np.ndarray, at: np.ndarray, order: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, strings): each byte behind its `order` predecessors in the same text, as one number."""
    for s in range(0, len(data), _PIECE):
        e = min(s + _PIECE, len(data))
        strings = data[s:e].astype(np.int64)
        for back in range(1, order + 1):
            before = np.full(e - s, _START, np.int64)
            before[max(0, back - s) :] = data[max(0, s - back) : max(0, e - back)]
            for t in range(back):
                starts = at[np.searchsorted(at, s - t) : np.searchsorted(at, e - t)] + t - s
                before[starts] = _START
            strings |= before << (8 * back)
        yield s, e, strings


def _counter(order: int):
    def table(lang: str, strings: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([lang] * len(strings), pa.string()), pa.array(strings), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "string", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, len(whole), _ROWS)):
            langs, texts = batch.column("lang"), batch.column("text")
            for lang in pc.unique(langs).to_pylist():
                for _, _, strings in _strings(*_buffer(texts.filter(pc.equal(langs, lang))), order):
                    strings, n = np.unique(strings, return_counts=True)
                    if lang in sums:
                        known = sums[lang]
                        strings, where = np.unique(np.concatenate([known[0], strings]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([known[1], n])).astype(np.int64)
                    sums[lang] = strings, n.astype(np.int64)
                    if sum(len(k) for k, _ in sums.values()) > _HELD:
                        for each, (k, m) in sums.items():
                            yield table(each, k, m)
                        sums = {}
        for each, (k, m) in sums.items():
            yield table(each, k, m)

    return count


def count_strings(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, length, string (so many bytes as one number), n, seen (times its context was): over all texts
    with a language."""
    if not 0 <= order <= 6:
        raise ValueError("order must lie between 0 and 6, so that a string fits into a long")
    taught = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    partial = taught.mapInArrow(_counter(order), "lang string, string bigint, n bigint")
    longest = partial.groupBy("lang", "string").agg(F.sum("n").alias("n"))
    cut = F.explode(
        F.array(*[
            F.struct(F.lit(k).alias("length"), F.col("string").bitwiseAND(F.lit((1 << 8 * k) - 1).cast("bigint")).alias("string"))
            for k in range(1, order + 2)
        ])
    )
    all_lengths = longest.select("lang", cut.alias("s"), "n").groupBy("lang", "s.length", "s.string")
    context = Window.partitionBy("lang", "length", F.shiftright("string", 8))
    return all_lengths.agg(F.sum("n").alias("n")).withColumn("seen", F.sum("n").over(context))


def kept(counts: DataFrame, cells: int = CELLS) -> tuple[list[str], int]:
    """The languages, and how often a context must have been seen for the tree to have at most `cells` costs."""
    most = int((cells // 256) ** 0.5)
    languages = [r[0] for r in counts.where("length = 1").select("lang").distinct().sort("lang").limit(most + 1).collect()]
    if len(languages) > most:
        raise ValueError(f"{cells} cells hold at most {most} languages")
    # At most 64 rows: entries by the power of two of how often their context was seen.
    power = F.when(F.col("length") == 1, 63).otherwise(F.length(F.bin("seen")) - 1)
    by_power = dict(counts.groupBy(power.alias("power")).count().collect())
    entries, least = by_power.pop(63, 0), 63
    while least > 0 and (entries + by_power.get(least - 1, 0)) * len(languages) <= cells:
        least -= 1
        entries += by_power.get(least, 0)
    return languages, 1 << least


def _level(
    order: int, strings: np.ndarray, which: np.ndarray, n: np.ndarray, languages: int, shorter: Level | None
) -> Level:
    """The costs of one order, given those of the next shorter one."""
    known, place = np.unique(strings, return_inverse=True)
    contexts, parent = np.unique(known >> 8, return_inverse=True)
    if shorter is None:
        below = np.full((languages, len(known)), _UNSEEN)
    else:
        # Where a context has a node, so has the one without its first byte: its strings are known.
        suffix = known & ((1 << 8 * order) - 1)
        below = shorter.cost[:, np.searchsorted(shorter.strings, suffix)].astype(np.float64)
    cost, escape = np.zeros((languages, len(known)), np.float32), np.zeros((languages, len(contexts)), np.float32)
    for k in range(languages):
        mine = which == k
        count = np.zeros(len(known))
        count[place[mine]] = n[mine]
        total = np.bincount(parent, count, len(contexts))
        kinds = np.bincount(parent, count > 0, len(contexts))
        whole = np.log2(np.maximum(total + kinds, 1))
        escape[k] = np.where(kinds > 0, whole - np.log2(np.maximum(kinds, 1)), 0.0)
        cost[k] = np.where(count > 0, whole[parent] - np.log2(np.maximum(count, 1)), escape[k][parent] + below[k])
    return Level(known, cost, contexts, escape)


def freeze(counts: pa.Table, languages: list[str]) -> Model:
    """The tree of a table of lang, length, string, n."""
    which = pc.index_in(counts.column("lang"), pa.array(languages, pa.string())).to_numpy()
    length, string, n = (counts.column(c).to_numpy() for c in ("length", "string", "n"))
    levels: list[Level] = []
    for order in range(int(length.max(initial=0))):
        here = length == order + 1
        shorter = levels[-1] if levels else None
        levels.append(_level(order, string[here], which[here], n[here], len(languages), shorter))
    return Model(languages, levels)


def train(labelled: DataFrame, order: int = ORDER, cells: int = CELLS) -> Model:
    """Learn from all rows' text and lang; no other column is used."""
    counts = materialise(count_strings(labelled, order), "contexts")
    languages, least = kept(counts, cells)
    tree = counts.where((F.col("length") == 1) | (F.col("seen") >= least))
    return freeze(tree.select("lang", "length", "string", "n").toArrow(), languages)


def _costs(model: Model, strings: np.ndarray) -> np.ndarray:
    """language x string: bits of the last byte of each string."""
    bits = np.zeros((len(model.languages), len(strings)))
    left = np.arange(len(strings))
    for order in range(len(model.levels) - 1, -1, -1):
        level = model.levels[order]
        string = strings[left] & ((1 << 8 * (order + 1)) - 1)
        at = np.minimum(np.searchsorted(level.strings, string), len(level.strings) - 1)
        found = level.strings[at] == string
        bits[:, left[found]] += level.cost[:, at[found]]
        left, context = left[~found], string[~found] >> 8
        at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
        node = level.contexts[at] == context
        bits[:, left[node]] += level.escape[:, at[node]]
    bits[:, left] += _UNSEEN
    return bits


def code_lengths(model: Model, texts: pa.Array) -> np.ndarray:
    """Bits of each text under each language."""
    data, at = _buffer(texts)
    bits = np.zeros((len(model.languages), len(texts)))
    for s, e, strings in _strings(data, at, len(model.levels) - 1):
        first, last = np.searchsorted(at, s, "right") - 1, np.searchsorted(at, e, "left")
        low, high = np.clip(at[first:last], s, e) - s, np.clip(at[first + 1 : last + 1], s, e) - s
        different, where = np.unique(strings, return_inverse=True)
        for k, cost in enumerate(_costs(model, different)):
            run = np.zeros(e - s + 1)
            np.cumsum(cost.take(where), out=run[1:])
            bits[k, first:last] += run[high] - run[low]
    return bits


def judge(model: Model, texts: pa.Array) -> pa.StructArray:
    """The language and score of each text."""
    lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
    language, score = np.full(len(texts), UNDETERMINED, dtype=object), np.zeros(len(texts))
    if model.languages and len(texts):
        bits = code_lengths(model, texts)
        best = bits.argmin(axis=0)
        share = 1 / np.exp2(np.maximum(bits.min(axis=0) - bits, -1000)).sum(axis=0)
        language[lettered] = np.array(model.languages, dtype=object)[best[lettered]]
        score[lettered] = np.minimum(share, 1.0)[lettered]
    return pa.StructArray.from_arrays([pa.array(language, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])


def predictor(spark: SparkSession, model: Model):
    """A function from a text column to a struct of lang_pred and score."""
    plain = [(v.strings, v.cost, v.contexts, v.escape) for v in model.levels]  # of no class that a worker may lack
    shared = spark.sparkContext.broadcast((model.languages, plain))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(texts: pa.Array) -> pa.Array:
        languages, levels = shared.value
        model = Model(languages, [Level(*v) for v in levels])
        judged = pa.concat_arrays([judge(model, texts.slice(at, _ROWS)) for at in range(0, max(len(texts), 1), _ROWS)])
        pa.default_memory_pool().release_unused()  # a worker stays, with what it holds
        return judged

    return predicted


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; one without doc_id is neither learned nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_from(docs: DataFrame) -> DataFrame:
    """The documents that teach: those with doc_id and language that are not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    predicted = predictor(spark, train(learned_from(docs)))
    judged = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted("text").alias("_p"))
    return judged.select("doc_id", "held_out", "_p.lang_pred", "_p.score")
