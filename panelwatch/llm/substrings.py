"""Operator 4: remove bytes covered by long strings that occur more than once, by anchor hashing.

This stands in for prefix doubling, which ranks every position by its first bytes and then, offset by
offset, by pairs of ranks, and moves a row for every byte of the corpus in each round (the README has an
estimate of what that costs). Here only few positions are moved, without missing any:

* The start of every string of `length` bytes is represented by its anchor, the position of the least hash
  among its substrings of half the length. Equal strings have equal anchors, and neighbours mostly share
  one, so starts fall into runs, one for about a hundred bytes, each named by its anchor's half-length string.
* Runs whose name occurs once cannot hold a repeated string and are dropped. Runs that are equal as a whole
  are repeated as a whole. Otherwise one run of each kind goes on.
* Two fixed cuts make shorter runs (`BLOCK` starts, then one). All strings of a short run share a core longer
  than half, named by the half-length strings at both its ends; with one start, these span the whole
  length. Again unique cores are dropped.

Names are 64-bit hashes of half-length strings, computed from the text where it lies. Equality is
always decided on two of them, 128 bits. Spark groups and joins the rows of names; hot names are counted
before the shuffle and joined by plain joins, which adaptive execution splits. No group is collected.

Defined cases: a null text has no bytes; texts shorter than `length` lose nothing; rows with null or equal
doc_id are documents of their own (a row is known by its place in its file); an empty table gives no rows;
very long texts are hashed in pieces; extra columns are kept by `repeated_spans`, except `removed`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.llm.common import fresh, run_anywhere, small_lists, unpacked, with_row_key, without
from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

run_anywhere(__name__)

LENGTH = 400
BLOCK = 25
_PIECE = 1 << 18  # starts hashed at a time
_ROOM = _PIECE + (1 << 14)
_KEY = ["_f", "_r"]
_UNIT = "_f bigint, _r bigint, first int, last int, anchor int, core bigint, whole bigint"

_WIDE = np.uint64
# An odd number that is 3 modulo 8, so that few of its powers are near 1 modulo powers of two.
_BASE = 0x9E3779B97F4A7C13
_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, and the powers of the base and of its inverse; made once per process."""
    if _BASE not in _TABLES:
        def powers(x: int) -> np.ndarray:
            steps = np.full(2 * _ROOM, x, _WIDE)
            steps[0] = 1
            return np.cumprod(steps, dtype=_WIDE)

        values = np.random.default_rng(4).integers(0, 1 << 64, 256, dtype=_WIDE)
        _TABLES[_BASE] = values, powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
    return _TABLES[_BASE]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _WIDE(32))) * _WIDE(0xD6E8FEB86659FD93)
    return x ^ (x >> _WIDE(29))


def _ranks(data: np.ndarray, half: int) -> np.ndarray:
    """The hash of the `half` bytes from every position."""
    values, power, inverse = _tables()
    n = len(data)
    sums = np.zeros(n + 1, _WIDE)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    return _mixed((sums[half:] - sums[:-half]) * inverse[: n - half + 1])


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(_WIDE).max, _WIDE)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (with the end of the last)."""
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def _groups(at: np.ndarray, length: int, room: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of texts, some at a time: (document, first start, end of starts, end of text) of each piece."""
    size = np.diff(at)
    starts = np.maximum(size - length + 1, 0)
    count = -(-starts // _PIECE)
    doc = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = number * _PIECE
    last = np.minimum(first + _PIECE, starts[doc])
    end = np.minimum(last + length - 1 + room, size[doc])
    total = np.cumsum(end - first)
    begin = 0
    while begin < len(doc):
        spent = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, spent + _PIECE, "right")))
        yield doc[begin:stop], first[begin:stop], last[begin:stop], end[begin:stop]
        begin = stop


def _joined(data: np.ndarray, at: np.ndarray, doc: np.ndarray, first: np.ndarray, end: np.ndarray):
    """The pieces' bytes in a row, and where each piece begins in them."""
    parts = [data[at[d] + s : at[d] + e] for d, s, e in zip(doc, first, end, strict=True)]
    begin = np.concatenate([[0], np.cumsum(end - first)])
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)), begin


def _whole(rank: np.ndarray, p1: np.ndarray, p2: np.ndarray, half: int, extra: np.ndarray) -> np.ndarray:
    """A hash of all bytes that the strings starting at p1 to p2 cover; they overlap, p2 - p1 being at most half."""
    return _mixed(rank[p1] + _mixed(rank[p1 + half] + _mixed(rank[p2 + half] + _mixed(extra.astype(_WIDE)))))


def _batch(f, r, first, last, anchor, core, whole) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(f), pa.array(r), *[pa.array(x.astype(np.int32)) for x in (first, last, anchor)],
         *[pa.array(x.view(np.int64)) for x in (core, whole)]],
        names=["_f", "_r", "first", "last", "anchor", "core", "whole"],
    )


def _runs(length: int):
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _texts(batch.column("text"))
            f, r = batch.column("_f").to_numpy(), batch.column("_r").to_numpy()
            for doc, first, last, end in _groups(at, length, 0):
                piece, begin = _joined(data, at, doc, first, end)
                rank = _ranks(piece, half)
                place = np.arange(len(rank), dtype=_WIDE)
                keyed = (rank & ~_WIDE((1 << 24) - 1)) | place
                anchor = (_least_of(keyed, length - half + 1) & _WIDE((1 << 24) - 1)).astype(np.int64)
                # The starts whose string lies within its piece, with the piece of each.
                counts = last - first
                which = np.repeat(np.arange(len(doc)), counts)
                start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begin[which]
                at_anchor = anchor[start]
                new = np.flatnonzero((np.diff(at_anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
                p1, p2 = start[new], start[np.append(new[1:], len(start)) - 1]
                a, of = at_anchor[new], which[new]
                extra = (p2 - p1) * (length + 1) + (a - p1)
                shift = first[of] - begin[of]
                rows = doc[of]
                yield _batch(f[rows], r[rows], p1 + shift, p2 + shift, a + shift, rank[a], _whole(rank, p1, p2, half, extra))

    return run


def _cut(length: int, width: int):
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _texts(batch.column("text"))
            f, r = batch.column("_f").to_numpy(), batch.column("_r").to_numpy()
            units = batch.column("units")
            unit_doc = np.repeat(np.arange(len(units)), units.value_lengths().to_numpy(zero_copy_only=False))
            flat = units.flatten()
            lo, hi, anchor = (flat.field(x).to_numpy().astype(np.int64) for x in ("first", "last", "anchor"))
            for doc, first, last, end in _groups(at, length, 2 * length):
                # Units by the piece in which they start.
                lower = np.searchsorted(unit_doc, doc[0], "left")
                upper = np.searchsorted(unit_doc, doc[-1], "right")
                mine = np.arange(lower, upper)
                mine = mine[(lo[mine] >= np.where(unit_doc[mine] == doc[0], first[0], 0))]
                mine = mine[(unit_doc[mine] != doc[-1]) | (lo[mine] < last[-1])]
                if not len(mine):
                    continue
                piece, begin = _joined(data, at, doc, first, end)
                rank = _ranks(piece, half)
                # A group holds whole texts, or pieces of one; so a unit's piece is its text's only one here,
                # or found by its start.
                of = np.searchsorted(doc, unit_doc[mine], "left")
                of += np.where(doc[of] == unit_doc[mine], (lo[mine] - first[of]) // _PIECE, 0)
                shift = begin[of] - first[of]
                for k in range(half // width + 1):
                    # The starts that lie `width * k` to `width * (k + 1) - 1` bytes before the anchor.
                    p1 = np.maximum(lo[mine], anchor[mine] - width * (k + 1) + 1)
                    p2 = np.minimum(hi[mine], anchor[mine] - width * k)
                    has = np.flatnonzero(p1 <= p2)
                    if not len(has):
                        continue
                    s, m = shift[has], mine[has]
                    near, far = anchor[m] - width * k + s, anchor[m] - width * (k + 1) + 1 + half + s
                    if width == 1:
                        core, whole = rank[near], rank[far]
                    else:
                        core = _mixed(rank[near] + _mixed(rank[far] + _WIDE(k)))
                        extra = (p2[has] - p1[has]) * (length + 1) + (anchor[m] - p1[has])
                        whole = _whole(rank, p1[has] + s, p2[has] + s, half, extra)
                    rows = unit_doc[m]
                    yield _batch(f[rows], r[rows], p1[has], p2[has], anchor[m], core, whole)

    return run


def _resolve(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of one round: the rows that are repeated as a whole, and one row of each kind (core and whole).

    Counts are written before they are joined, so both sides of a join are plain shuffles, of which
    adaptive execution can split a hot rank.
    """
    ranked = materialise(rows.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "ranks")
    shared = materialise(rows.join(ranked, "core"), "shared_ranks")
    unit = F.struct(*_KEY, "first", "last", "anchor")
    kinds = materialise(shared.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(unit).alias("unit")), "kinds")
    repeated = shared.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"])
    return repeated.select(*_KEY, "first", "last"), kinds


def _open(kinds: DataFrame) -> DataFrame:
    """The rows to cut for the next round: one of each kind of the ranks that have several."""
    several = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    return kinds.join(materialise(several, "open_ranks"), "core").select("unit.*")


def _by_text(keyed: DataFrame, units: DataFrame) -> DataFrame:
    """The texts that have units, each with all of its own."""
    unit = F.struct("first", "last", "anchor")
    lists = materialise(units.groupBy(*_KEY).agg(F.collect_list(unit).alias("units")), "units")
    return lookup(keyed, lists, _KEY, small=small_lists(lists, "units"), salt_by=_KEY)


@F.arrow_udf(T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())))
def _merged(units: pa.Array) -> pa.Array:
    """Maximal intervals covered by any of a text's [start, end)."""
    out = []
    for row in units:
        spans: list[dict[str, int]] = []
        for unit in sorted((u["start"], u["end"]) for u in row.as_py() or ()):
            if spans and unit[0] <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], unit[1])
            else:
                spans.append({"start": unit[0], "end": unit[1]})
        out.append(spans)
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


@F.arrow_udf(T.BinaryType())
def kept_bytes(texts: pa.Array, removed: pa.Array) -> pa.Array:
    """The bytes of texts that are not removed, one after the other."""
    out = []
    for text, spans in zip(texts, removed, strict=True):
        data = (text.as_py() or "").encode()
        kept, at = [], 0
        for span in spans.as_py() or ():
            kept.append(data[at : span["start"]])
            at = span["end"]
        out.append(b"".join([*kept, data[at:]]) if at else data)
    return pa.array(out, pa.binary())


def repeated_spans(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """The documents with `removed`: the maximal byte ranges covered by strings that occur elsewhere too."""
    docs = without(docs, ["removed"])
    row = fresh(docs, "_row")
    half = length // 2
    if length % 2 or not 0 < block <= half:
        raise ValueError("the length must be even, and a block at most its half")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    keyed = with_row_key(docs, row).select(
        whole, "text", F.xxhash64(F.col(row)["file"]).alias("_f"), F.col(row)["row"].alias("_r")
    )
    texts = keyed.where(F.octet_length("text") >= length).select(*_KEY, "text")

    repeated, kinds = _resolve(materialise(texts.mapInArrow(_runs(length), _UNIT), "runs"))
    found = [repeated]
    for width in dict.fromkeys((block, 1)):
        cut = _by_text(texts, _open(kinds)).mapInArrow(_cut(length, width), _UNIT)
        repeated, kinds = _resolve(materialise(cut, "cut_runs"))
        found.append(repeated)
    covered = found[0]
    for more in found[1:]:
        covered = covered.unionAll(more)
    span = F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    lists = covered.groupBy(*_KEY).agg(F.collect_set(span).alias("_units"))
    spans = materialise(lists.select(*_KEY, _merged("_units").alias("_spans")), "removed")
    joined = lookup(keyed.drop("text"), spans, _KEY, "left", small=small_lists(spans, "_spans"), salt_by=_KEY)
    none = F.array().cast("array<struct<start: int, end: int>>")
    return unpacked(joined, "doc", F.coalesce("_spans", none).alias("removed"))


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kept = found.withColumn("kept", kept_bytes("text", "removed"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return kept.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        (F.size("removed") > 0).alias("repeated"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = f"""
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), starts AS (
  SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - {LENGTH - 1}, 0))) AS p FROM texts
), hashed AS (
  SELECT doc_id, p, hash(substr(x, 2 * p + 1, {2 * LENGTH})) AS k FROM starts
), repeated AS (
  SELECT doc_id, p FROM hashed WHERE k IN (SELECT k FROM hashed GROUP BY k HAVING count(*) > 1)
), marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS new FROM repeated
), numbered AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), spans AS (
  SELECT doc_id, min(p) AS s, max(p) + {LENGTH} AS e FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM spans
  UNION ALL
  SELECT t.doc_id, coalesce(max(e), 0), len(any_value(x)) // 2 FROM texts t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS left_over
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id
), counted AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(n_spans, 0) > 0 AS repeated, sha256(unhex(left_over)) AS kept_sha256
FROM texts JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""
