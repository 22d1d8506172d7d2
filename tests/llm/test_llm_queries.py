"""The registered queries of the subpackage against their SQL or defining properties, and the pipeline."""

import hashlib
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
import regex
from llm_data import CLASHING, SCHEMA, documents, frame
from test_llm_mixing_sharding import brute_targets, n_words
from test_llm_text_operators import brute_print, brute_roots, brute_similarity

import __spark_entry__ as driver
from panelwatch.llm import decontamination, mixing, queries, simhash

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
COLUMNS = {
    "op1_mix_sources": "doc_id size source_size target taken",
    "op2_format_chats": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3_url_filter": "page_id host path rule verdict",
    "op4_repeated_substrings": "doc_id n_bytes n_removed n_spans repeated kept_sha256",
    "op5_decontaminate": "doc_id contaminated n_items item_id similarity",
    "op6_language": "doc_id held_out lang_pred score",
    "op7_top_k": "query_id rank vec_id score",
    "op8_near_duplicates": "doc_id fingerprint component_id",
    "op9_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_shard_documents": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_lines failures",
    "op13_whiten": "vec_id component n deviation whitened explained identity_error",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables are not there")


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS) and {*COLUMNS, "pipeline"} <= set(driver.queries())
    assert set(queries.SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.SQL)))
def test_query_returns_a_row_for_all_input(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert df.columns == COLUMNS[name].split()
    table, key, more = {
        "op2": ("conversations", "conv_id", 1), "op3": ("pages", "page_id", 0), "op13": ("embeddings", "vec_id", 0)
    }.get(name.split("_")[0], ("documents", "doc_id", 0))
    ids = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    expected = ids.distinct().count() + more if more else ids.count()
    assert df.count() == expected * (4 if name == "op13_whiten" else 1)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(queries.SQL[name])
    described = {c[0]: TYPES[str(c[1])] for c in result.description}
    df = queries.QUERIES[name](spark, SF_DIR)
    assert dict(df.dtypes) == described
    assert Counter(map(tuple, df.select(*described).collect())) == Counter(result.fetchall())


def test_language_is_predicted_well_where_it_was_not_learned(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    judged = queries.QUERIES["op6_language"](spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(judged) > 30 and sum(r.lang_pred == r.lang for r in judged) >= 0.95 * len(judged)


def test_pipeline_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    spent = Counter()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        extra = ["shard", "slot"] if name == "sharding" else []
        assert out.columns == [*docs.columns, *extra]
        before, after = (Counter(r.doc_id for r in df.select("doc_id").collect()) for df in (docs, out))
        assert set(after) <= set(before)
        spent[name] = sum(before.values()) - sum(after.values())
        if name == "near_dedup":
            assert set(after) == {r.component for r in simhash.classes(docs).select("component").distinct().collect()}
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            assert set(after) == {r.doc_id for r in decontamination.report(docs, bench).where("NOT contaminated").collect()}
        if name == "mixing":
            assert set(after.values()) <= {1, 2}
        if name == "sharding":
            assert before == after
        docs = out.cache()
    assert spent["near_dedup"] > 0 and spent["decontamination"] > 0 and spent["language"] == 0


def brute_pipeline(docs, items):
    """doc_id and times of all documents that the stages leave, in plain Python."""
    kept = [d for d in docs if any(c.isalpha() for c in d.text or "")]
    prints = {d.doc_id: brute_print(d.text) for d in kept}
    roots = brute_roots(sorted(set(prints.values())))
    first = {}
    for i, p in prints.items():
        first[roots[p]] = min(i, first.get(roots[p], i))
    kept = [d for d in kept if d.doc_id == first[roots[prints[d.doc_id]]]]

    words = lambda t: regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower())
    benchmark = [words(i.text) for i in items if words(i.text)]

    def holds_item(text):
        ws = words(text)
        return bool(ws) and any(
            brute_similarity(ws[s : s + len(it)], it) >= 0.8 for it in benchmark for s in range(max(1, len(ws) - len(it) + 1))
        )

    kept = [d for d in kept if not holds_item(d.text)]
    size = {d.doc_id: n_words(d.text) for d in kept}
    sizes = Counter()
    for d in kept:
        sizes[d.source] += size[d.doc_id]
    wanted = brute_targets(dict(sizes))
    times = Counter()
    for d in kept:
        rate = float(wanted[d.source]) / sizes[d.source]
        draw = int(hashlib.md5(f"{mixing.SEED}:{d.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        times[d.doc_id] += int(rate) + (draw < rate - int(rate))
    return +times


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in out) == brute_pipeline(docs, items)
    slots = Counter(r.shard for r in out)
    assert max(slots.values()) - min(slots.values()) <= 1
    assert {(r.shard, r.slot) for r in out} == {(k, i) for k, n in slots.items() for i in range(n)}


def test_pipeline_takes_odd_documents(spark, tmp_path):
    frame(spark, documents(), SCHEMA, None, CLASHING).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, None), (1, "some item of words")], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    out = corpus_pipeline.run(spark, str(tmp_path))
    kept = {r.doc_id for r in out.collect()}
    assert {0, 1, 7, 10}.isdisjoint(kept) and len(kept) > 20
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns)


def test_pipeline_of_nothing(spark, tmp_path):
    frame(spark, [], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
