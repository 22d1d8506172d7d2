"""Operator 11 against plain Python: the double array, the trie in pieces of any size, and the shared history."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import CLASHING, frame, text

from panelwatch.llm import prefixes
from panelwatch.llm.double_array import ROOT, DoubleArray

TURNS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("seed", range(4))
def test_double_arrays_hold_just_their_paths(seed):
    r = random.Random(seed)
    codes = (3, 40, 400, 5000)[seed]
    paths = sorted({tuple(r.randrange(codes) for _ in range(r.randrange(1, 7))) for _ in range(600)})
    trie, at, known = DoubleArray(codes), np.zeros(len(paths), np.int64), {(): ROOT}
    for depth in range(6):
        going = np.array([i for i, p in enumerate(paths) if len(p) > depth], int)
        code = np.array([paths[i][depth] for i in going], int)
        trie.add(at[going], code)
        at[going] = trie.child(at[going], code)
        known |= {paths[i][: depth + 1]: int(at[i]) for i in going}
    assert len(set(known.values())) == len(known) and min(known.values()) == ROOT
    for prefix, slot in known.items():
        there = trie.child(np.full(codes, slot), np.arange(codes))
        assert {c: int(t) for c, t in enumerate(there) if t >= 0} == {
            p[-1]: s for p, s in known.items() if p and p[:-1] == prefix
        }
    assert trie.end <= 2 * len(known) + codes


def ordered(rows):
    """The turns (role, text) of every conversation, in order."""
    by_conv = defaultdict(list)
    for conv, turn, role, said in rows:
        if conv is not None:
            role, said = role or "", said or ""
            key = hashlib.md5(f"{len(role)}:{role}{said}".encode()).digest()
            by_conv[conv].append(((turn is not None, turn or 0), role.encode(), key, (role, said)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in by_conv.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        # The remainder has the sign of the id, as in SQL.
        out[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    return out


def brute_nodes(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        words = len(node[-1][1].encode().split()) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    return Counter(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def conversations(n=160):
    r = random.Random(9)
    rows = []
    for c in range(n):
        openings = [("system", "be kind"), ("user", text(c % 3, 4)), ("assistant", text(c % 7, 6)), ("user", text(c % 11, 3))]
        turns = openings[: r.randrange(5)] + [(r.choice(["user", "assistant"]), text(c * 9 + k, 5)) for k in range(r.randrange(4))]
        rows += [(c, t, role, said) for t, (role, said) in enumerate(turns)]
    rows += [(1000 + i, t, "user", text(t, 3)) for i in range(70) for t in range(3)]  # copies
    rows += [(2000, None, "user", "before all"), (2000, 1, None, None), (2000, 1, "", ""), (2000, 1, "b", "tie"), (2000, 1, "a", "tie")]
    rows += [(2001, 5, "user", "again and again")] * 3 + [(2001, 5, "user", "again"), (2001, 5, "1:us", "er")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (-25, 0, "user", "negative"), (-7, 0, "user", "negative")]
    rows += [(3000 + i, t, "user", "same" if t < 40 else text(i, 2)) for i in range(3) for t in range(45)]  # deep
    rows += [(4001, 0, "user", "x"), (4002, 0, "user", "x"), (4017, 0, "user", "x")]  # no first one of their block
    rows += [(5000, 0, "user", "é 𝒳 \x00 " + "long " * 30_000)]
    r.shuffle(rows)
    return rows


def nodes_of(df):
    return Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()
    )


@pytest.mark.parametrize("sizes", [{}, {"chunk": 40, "task": 150, "fan": 2}, {"chunk": 1, "task": 60, "fan": 3}])
def test_nodes_equal_brute_force(spark, sizes):
    rows = conversations()
    table = frame(spark, rows, TURNS, None, {**CLASHING, "turns": "int", "keys": "int", "n": "int", "head": "int"})
    listed = prefixes.with_shared_history(prefixes.sequences(table))
    assert nodes_of(prefixes.trie(listed, **sizes)) == brute_nodes(rebuilt(ordered(rows)))


def test_nodes_of_conversations_as_they_are(spark, tmp_path):
    rows = conversations(40)
    found = prefixes.trie(prefixes.sequences(frame(spark, rows, TURNS, tmp_path)), chunk=64)
    assert nodes_of(found) == brute_nodes(ordered(rows))


def test_one_conversation_and_none(spark):
    for rows in ([], [(None, 0, "user", "x")], [(40, 0, "user", "a b")], [(41, 0, None, None)]):
        convs = rebuilt(ordered(rows))
        found = prefixes.trie(prefixes.with_shared_history(prefixes.sequences(frame(spark, rows, TURNS))))
        assert nodes_of(found) == brute_nodes(convs)


def test_ids_of_a_large_group_are_digested_in_order(spark):
    ids = [i * 37 % 5000 - 900 for i in range(5000)]
    rows = [(i, 0, "user", "same") for i in ids]
    found = nodes_of(prefixes.trie(prefixes.sequences(frame(spark, rows, TURNS))))
    assert found == brute_nodes(ordered(rows))
