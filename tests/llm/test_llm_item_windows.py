"""Operator 5 finds items whose parts stand in another order, or repeat, as brute force does."""

import random

import pytest
from llm_data import SCHEMA, frame, text
from test_llm_text_operators import brute_contaminated

from panelwatch.llm import decontamination


def test_swapped_halves_and_repeated_words(spark, tmp_path):
    r = random.Random(4)
    passages = [[f"w{i}x{j}" for j in range(40 + 3 * i)] for i in range(6)]
    passages += [["again", "and"] * 20, text(5, 20).split() * 2, ["same"] * 45]
    items = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(20, "word"), (21, "just three words")]
    rows = []
    for p in passages:
        for at in (len(p) // 2, len(p) // 3, 7):
            swapped = p[at:] + p[:at]
            for edits in (0, 1):
                body = list(swapped)
                for _ in range(edits):
                    body[r.randrange(len(body))] = "edited"
                rows.append((len(rows), f"{text(len(rows), 33)} {' '.join(body)} {text(len(rows), 25)}", "en", "a", 0))
    rows += [(len(rows) + i, t, "en", "a", 0) for i, t in enumerate(["same " * 44, "same " * 30, "again and " * 19, "a word", "", None])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {x.doc_id: x for x in decontamination.report(frame(spark, rows, SCHEMA, tmp_path), bench).collect()}
    swapped = 0
    for i, t, *_ in rows:
        found = brute_contaminated(t, items)
        assert (got[i].contaminated, got[i].n_items) == (bool(found), len(found)), (i, found)
        if found:
            assert got[i].similarity == pytest.approx(max(found.values()))
            swapped += max(found.values()) < 1
    assert swapped > 10


def test_items_without_an_id_are_items(spark, tmp_path):
    passages = [text(70 + i, 30) for i in range(4)]
    items = [(None, passages[0]), (None, passages[1]), (5, passages[1]), (7, passages[2]), (None, passages[2]), (None, None)]
    rows = [(i, f"{text(i, 20)} {p} {text(i + 9, 20)}", "en", "a", 0) for i, p in enumerate(passages)]
    docs = frame(spark, rows, SCHEMA, tmp_path)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_id, r.similarity) for r in decontamination.report(docs, bench).collect()}
    assert got == {0: (True, 1, None, 1.0), 1: (True, 2, 5, 1.0), 2: (True, 2, 7, 1.0), 3: (False, 0, None, None)}
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [3]
