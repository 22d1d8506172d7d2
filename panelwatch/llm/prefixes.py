"""Operator 11: the trie of conversation prefixes, with aggregates for every node.

A turn is known by a digest of its role and text, a conversation by the list of its turns' digests; texts
are not moved. Equal conversations become one path with a count before anything else, so copies by the
million are one row. Paths are sorted by range partitions, each a shard of neighbouring prefixes.

A task packs its shard, some ten thousand turns at a time, into a double array (`double_array.py`) over dense
ids of the turns it holds, and traverses it for the nodes. As paths are sorted, every node that another
shard may share lies on the shard's first or last path. All others are complete and are written at once.
The two paths, with what hangs from them already added up, are all that is left of a shard; they are packed
and traversed in turn, `FAN` shards at a time, until one group is left. So a node that all shards share
is merged from sums, no task sees more than its shard or 2 `FAN` paths, and a hot prefix is split like
any other. A node whose parent was completed later learns its parent's conversation by the parent's digest, in
a join that splits hot keys.

Defined cases: rows with a null conv_id take no part; null role and text are empty; turns of equal number
are ordered by role, then by the turn's digest (MD5 of the length of the role, a colon, role and text); equal rows are turns
of their own; a conversation without turns left ends at the root; an empty table gives no rows; extra
columns are not looked at. A conversation is one row of 24 bytes a turn, so the longest one must fit in a
task; the list of conversations that end at a node is digested as a stream, in one task for each such list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm.common import run_anywhere, words_in
from panelwatch.llm.double_array import ROOT, DoubleArray
from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

run_anywhere(__name__)
run_anywhere("panelwatch.llm.double_array")

CHUNK = 1 << 16  # turns in one double array, if no conversation is longer
TASK = 1 << 20  # turns of a shard
FAN = 128  # shards merged in one task
BLOCK = 20  # fixed values of the query's contract: conversations that share a beginning, and
HISTORY = 4  # one more than the most turns of it
_IDS = 512
_NONE = np.iinfo(np.int64).max
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = pa.struct(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
        ("digest", pa.binary()), ("parent_digest", pa.binary()),
    ]
)
_PATH = pa.struct(
    [
        ("part", pa.int32()), ("place", pa.int32()), ("keys", pa.list_(pa.binary())), ("words", pa.list_(pa.int64())),
        *[(c, pa.list_(pa.int64())) for c in ("n", "least", "children", "leaves", "saved")], ("ends", pa.list_(pa.string())),
    ]
)
SCHEMA = (
    "node struct<conv_id: bigint, depth: bigint, parent_conv_id: bigint, n_convs: bigint, n_children: bigint,"
    " n_leaves: bigint, saved_tokens: bigint, ends_sha256: string, digest: binary, parent_digest: binary>,"
    " path struct<part: int, place: int, keys: array<binary>, words: array<bigint>, n: array<bigint>,"
    " least: array<bigint>, children: array<bigint>, leaves: array<bigint>, saved: array<bigint>, ends: array<string>>"
)


@dataclass
class Path:
    """A path from the root: keys and words of its turns, and for the root and every turn the members, the
    least of them, the children, leaves and saved words below that are complete, and the digest of ends."""

    keys: list[bytes]
    words: np.ndarray
    n: np.ndarray
    least: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ends: list[str | None]

    @staticmethod
    def of(keys: list[bytes], words: list[int], n: int, least: int, ends: str) -> Path:
        """A path of `n` equal conversations that end where it ends."""
        size = len(keys) + 1
        none = np.zeros(size, np.int64)
        return Path(
            keys, np.array(words, np.int64), np.full(size, n), np.full(size, least), none, none, none, [None] * len(keys) + [ends]
        )


def below(digest: bytes, key: bytes) -> bytes:
    """The digest of a node from its parent's."""
    return hashlib.blake2b(digest + key, digest_size=16).digest()


def complete(paths: list[Path], final: bool, digests: bool) -> tuple[pa.StructArray, list[Path]]:
    """The nodes of sorted paths that no other shard shares, and the first and last path with the others.

    In the final round nothing else is left, so all nodes are complete. `digests` asks for those of all
    complete nodes, which children that were completed earlier look for.
    """
    keys = pa.array([k for p in paths for k in p.keys], pa.binary()).dictionary_encode()
    codes = keys.indices.to_numpy().astype(np.int64)
    lengths = np.array([len(p.keys) for p in paths])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    roots = starts + np.arange(len(paths))
    words = np.concatenate([p.words for p in paths])
    sums = {c: np.concatenate([getattr(p, c) for p in paths]) for c in ("n", "children", "leaves", "saved")}
    least_of = np.concatenate([p.least for p in paths])
    trie = DoubleArray(len(keys.dictionary))

    # Down: pack a level, then traverse it.
    at = np.full(len(paths), ROOT)
    levels, visits = [np.array([ROOT])], [(np.arange(len(paths)), at.copy())]
    trail = [np.full(2, ROOT)]
    depth = 0
    while True:
        going = np.flatnonzero(lengths > depth)
        if not len(going):
            break
        code = codes[starts[going] + depth]
        trie.add(at[going], code)
        at[going] = trie.child(at[going], code)
        visits.append((going, at[going]))
        levels.append(np.unique(at[going]))
        trail.append(np.where(lengths[[0, -1]] > depth, at[[0, -1]], -1))
        depth += 1

    size = trie.end
    depths, own_words, code_of = (np.zeros(size, np.int64) for _ in range(3))
    totals = {c: np.zeros(size, np.int64) for c in sums}
    least, ends = np.full(size, _NONE), {}
    for d, (going, slots) in enumerate(visits):
        for c, total in totals.items():
            np.add.at(total, slots, sums[c][roots[going] + d])
        np.minimum.at(least, slots, least_of[roots[going] + d])
        depths[slots] = d
        if d:
            own_words[slots] = words[starts[going] + d - 1]
            code_of[slots] = codes[starts[going] + d - 1]
    slot_lists = {}
    for d, (going, slots) in enumerate(visits):
        slot_lists[d] = dict(zip(going.tolist(), slots.tolist(), strict=True))
    for i, p in enumerate(paths):
        for d, end in enumerate(p.ends):
            if end is not None:
                ends[slot_lists[d][i]] = end

    shared = np.zeros(size, bool)
    if not final:
        for both in trail:
            shared[both[both >= 0]] = True

    # Up: what is complete is added to its parent.
    n, children, leaves, saved = (totals[c] for c in ("n", "children", "leaves", "saved"))
    for d in range(len(levels) - 1, -1, -1):
        done = levels[d][~shared[levels[d]]]
        leaves[done] = np.where(children[done] == 0, 1, leaves[done])
        saved[done] += (n[done] - 1) * own_words[done]
        if d:
            above = trie.check[done]
            np.add.at(children, above, 1)
            np.add.at(leaves, above, leaves[done])
            np.add.at(saved, above, saved[done])

    names = keys.dictionary
    digest = {ROOT: b"\0" * 16}
    for level in levels[1:]:
        for s in level if digests else level[shared[level]]:
            digest[int(s)] = below(digest[int(trie.check[s])], names[int(code_of[s])].as_py())

    done = np.concatenate(levels)
    done = done[~shared[done]]
    above = trie.check[done]
    open_above = shared[above]
    none = done == ROOT
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(least[done]),
            pa.array(depths[done]),
            pa.array(least[above], mask=none | open_above),
            pa.array(n[done]),
            pa.array(children[done]),
            pa.array(leaves[done]),
            pa.array(saved[done]),
            pa.array([ends.get(s) for s in done.tolist()], pa.string()),
            pa.array([digest[s] for s in done.tolist()] if digests else [None] * len(done), pa.binary()),
            pa.array([digest[s] if o else None for s, o in zip(above.tolist(), open_above.tolist(), strict=True)], pa.binary()),
        ],
        fields=list(_NODE),
    )
    if final:
        return nodes, []
    rest = []
    for which, path in ((0, paths[0]), (1, paths[-1])):
        slots = np.array([both[which] for both in trail if both[which] >= 0])
        # What both paths share is told by the first.
        told = np.zeros(len(slots), bool)
        if which:
            firsts = np.array([both[0] for both in trail])[: len(slots)]
            told[: len(firsts)] = firsts == slots[: len(firsts)]
            if told.all():
                break
        rest.append(
            Path(
                path.keys,
                path.words,
                *[np.where(told, 0, total[slots]) if total is not least else np.where(told, _NONE, least[slots]) for total in (n, least, children, leaves, saved)],
                [None if t else ends.get(s) for s, t in zip(slots.tolist(), told.tolist(), strict=True)],
            )
        )
    return nodes, rest


def _batches(nodes: pa.StructArray, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(nodes), size):
        part = nodes.slice(s, size)
        yield pa.RecordBatch.from_arrays([part, pa.nulls(len(part), _PATH)], ["node", "path"])


def _written(paths: list[Path], part: int) -> Iterator[pa.RecordBatch]:
    for place, p in enumerate(paths):
        row = {f.name: getattr(p, f.name) for f in fields(Path)} | {"part": part, "place": place}
        yield pa.RecordBatch.from_arrays([pa.nulls(1, _NODE), pa.array([row], _PATH)], ["node", "path"])


def _shard(chunk: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Path] = []
        rest: list[Path] = []
        turns = 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(Path.of(row["keys"], row["words"], row["n"], row["least"], row["ends"]))
                turns += len(row["keys"]) + 1
                if turns >= chunk:
                    nodes, more = complete(held, False, False)
                    yield from _batches(nodes)
                    held, turns, rest = [], 0, rest + more
                if len(rest) > 2 * fan:
                    nodes, rest = complete(rest, False, True)
                    yield from _batches(nodes)
        if held:
            nodes, more = complete(held, False, False)
            yield from _batches(nodes)
            rest += more
        if len(rest) > 2:
            nodes, rest = complete(rest, False, True)
            yield from _batches(nodes)
        yield from _written(rest, TaskContext.get().partitionId())

    return run


def _merge(fan: int, final: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted((r["path"] for r in table.to_pylist()), key=lambda p: (p["part"], p["place"]))
        paths = [
            Path(p["keys"], *[np.array(p[c], np.int64) for c in ("words", "n", "least", "children", "leaves", "saved")], p["ends"])
            for p in rows
        ]
        nodes, rest = complete(paths, final, True)
        return pa.Table.from_batches(
            [*_batches(nodes), *_written(rest, rows[0]["part"] // fan)], pa.schema([("node", _NODE), ("path", _PATH)])
        )

    return run


def sequences(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and `turns`, its turns in order as (key, words)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col("turn"), role.alias("role"), key.alias("key"), words_in(text).alias("words"))
    listed = conversations.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def with_shared_history(listed: DataFrame, block: int = BLOCK, history: int = HISTORY) -> DataFrame:
    """Conversations of a block begin with turns of its first one: h of them, by a checksum of the conversation's
    id below `history`, in place of their own first h. Remainders of negative ids are negative, as SQL has them."""
    listed = materialise(listed, "conversations")
    first = listed.where(F.col("conv_id") % block == 0)
    heads = first.select(F.col("conv_id").alias("_block"), F.slice("turns", 1, history - 1).alias("head"))
    joined = listed.withColumn("_block", F.col("conv_id") - F.col("conv_id") % block).join(heads, "_block", "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % history).cast("int")
    own = F.slice("turns", h + 1, F.size("turns"))
    told = F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own))
    return joined.select("conv_id", told.alias("turns"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each sorted run of id lists, read as a stream."""
    seq = digest = None
    for batch in batches:
        out = []
        for s, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if s != seq:
                if seq is not None:
                    out.append((seq, digest.hexdigest()))
                seq, digest = s, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["seq", "ends"])
    if seq is not None:
        yield pa.RecordBatch.from_arrays([pa.array([seq], pa.binary()), pa.array([digest.hexdigest()])], ["seq", "ends"])


def distinct_paths(listed: DataFrame) -> DataFrame:
    """Equal conversations as one path: keys, words, n, least, and the digest of the ids of all of them."""
    keys = F.transform("turns", lambda t: t["key"])
    seq = F.unhex(F.md5(F.array_join(F.transform(keys, lambda k: F.hex(k)), "")))
    told = materialise(
        listed.select("conv_id", seq.alias("seq"), keys.alias("keys"), F.transform("turns", lambda t: t["words"]).alias("words")),
        "sequences",
    )
    parts = told.groupBy("seq", F.expr(f"conv_id div {_IDS}").alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    )
    runs = parts.repartition("seq").sortWithinPartitions("seq", "range").select("seq", "ids")
    ends = runs.mapInArrow(_digests, "seq binary, ends string")
    grouped = told.groupBy("seq").agg(
        F.first("keys").alias("keys"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("least")
    )
    return materialise(grouped.join(ends, "seq").drop("seq"), "distinct_paths")


def trie(listed: DataFrame, chunk: int = CHUNK, task: int = TASK, fan: int = FAN) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = listed.sparkSession
    paths = distinct_paths(listed)
    turns = paths.agg(F.sum(F.size("keys") + 1)).first()[0] or 0
    shards = max(-(-turns // task), min(spark.sparkContext.defaultParallelism, -(-4 * turns // chunk)), 1)
    ranged = paths.repartitionByRange(shards, "keys").sortWithinPartitions("keys")
    found = materialise(ranged.mapInArrow(_shard(chunk, fan), SCHEMA), "shards")
    rounds = [found]
    while True:
        left = found.where("path IS NOT NULL").select("path")
        parts = (left.agg(F.max("path.part")).first()[0] or 0) + 1
        merged = left.groupBy(F.expr(f"path.part div {fan}").alias("group")).applyInArrow(_merge(fan, parts <= fan), SCHEMA)
        found = materialise(merged, "merged")
        rounds.append(found)
        if parts <= fan:
            break
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionAll(more)
    nodes = nodes.where("node IS NOT NULL").select("node.*")
    known = nodes.where("parent_digest IS NULL")
    late = nodes.where("parent_digest IS NOT NULL").drop("parent_conv_id")
    parents = nodes.where("digest IS NOT NULL").select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent_conv_id"))
    told = known.unionByName(lookup(late, parents, ["parent_digest"], salt_by=["conv_id", "depth"]))
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(with_shared_history(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


SQL = f"""
WITH ordered AS (
  SELECT conv_id, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words, turn, coalesce(role, '') AS role
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'key': key, 'words': words}} ORDER BY turn NULLS FIRST, encode(role), key) AS turns,
    -- The last two bits of the CRC-32 of the id as text: eight steps for each of its bytes.
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END), 4294967295) & {HISTORY - 1} AS h
  FROM ordered GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {BLOCK}
), visits AS (
  SELECT conv_id, len(turns) AS size, d AS depth, array_to_string(list_transform(turns[1:d], lambda t: t.key), '/') AS node,
    CASE WHEN d > 0 THEN array_to_string(list_transform(turns[1:d - 1], lambda t: t.key), '/') END AS parent,
    CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, any_value(words) AS words, count(*) AS n_convs, min(conv_id) AS conv_id,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM visits GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)
), subtrees AS (
  SELECT a.depth, a.node, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM counted b JOIN visits v ON v.conv_id = b.conv_id AND v.depth <= b.depth JOIN counted a ON a.depth = v.depth AND a.node = v.node
  GROUP BY a.depth, a.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  n.ends_sha256
FROM counted n JOIN subtrees s USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
"""
