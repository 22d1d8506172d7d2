"""Rows of a partitioned table, whose folders repeat file names, stay apart."""

from collections import Counter

from llm_data import SCHEMA, frame, text
from test_llm_text_operators import brute_spans

from panelwatch.llm import simhash, substrings


def partitioned(spark, rows, tmp_path):
    path = str(tmp_path / "partitioned")
    frame(spark, rows, SCHEMA).coalesce(1).write.partitionBy("source").parquet(path)
    docs = spark.read.parquet(path)
    names = [f.rsplit("/", 1)[-1] for f in docs.inputFiles()]
    assert len(set(names)) < len(names)
    return docs


def test_repeated_spans_of_a_partitioned_table(spark, tmp_path):
    texts = [text(1, 40), "x " + text(2, 60), text(3, 20) + text(2, 60), text(4, 90), text(1, 40) + " y", text(5, 10)]
    rows = [(i, t, "en", f"s{i}", 0) for i, t in enumerate(texts)]
    found = substrings.repeated_spans(partitioned(spark, rows, tmp_path), 64, 5).collect()
    got = {r.doc_id: [(s.start, s.end) for s in r.removed] for r in found}
    assert [got[i] for i in range(len(texts))] == brute_spans(texts, 64)


def test_representatives_of_a_partitioned_table(spark, tmp_path):
    texts = [text(1, 40), text(1, 40), text(2, 50), text(1, 40), text(2, 50), text(3, 60)]
    rows = [(i, t, "en", f"s{i}", 0) for i, t in enumerate(texts)]
    kept = simhash.representatives(partitioned(spark, rows, tmp_path))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, 2, 5])
