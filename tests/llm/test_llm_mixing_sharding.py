from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from llm_data import CLASHING, SCHEMA, documents, frame

from pyspark.sql import functions as F

from panelwatch.llm import mixing, sharding


def n_words(text):
    return len((text or "").encode().split())


def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    """Reshare the excess of capped sources until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_targets_are_reshared_until_none_is_above(spark):
    docs = documents()
    sizes = Counter()
    for _, text, _, source, _ in docs:
        sizes[source] += n_words(text)
    expected = brute_targets(dict(sizes))
    planned = mixing.plan(frame(spark, docs, SCHEMA)).collect()
    assert len(planned) == len(docs)
    for row in planned:
        assert row["size"] == n_words(row.text) and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(float(expected[row.source]))
        assert 0 <= row.copies <= 2


def test_mix_emits_planned_copies_with_the_documents_columns(spark, tmp_path):
    docs = frame(spark, documents(), SCHEMA, tmp_path, CLASHING)
    planned = mixing.plan(docs)
    emitted = mixing.emit(planned)
    assert [c for c in emitted.columns if c in SCHEMA] == ["doc_id", "text", "lang", "source", "n_chars"]
    wanted = Counter()
    for row in planned.collect():
        wanted[row.doc_id, row.text, row.source] += row.copies
    assert Counter((r.doc_id, r.text, r.source) for r in emitted.collect()) == +wanted


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (20 + i % 30), "en", f"s{i % 4 if i % 3 else 0}", 0) for i in range(4000)]
    docs = frame(spark, rows, SCHEMA)
    first = mixing.plan(docs).collect()
    taken = defaultdict(int)
    for r in first:
        taken[r.source, r.target] += r["size"] * r.copies
    for (_, target), words in taken.items():
        assert abs(words - target) < 0.05 * target
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.plan(docs.repartition(7)).collect()))


def repeated_ids():
    """Sources whose rows share an id, or have none, or are one row many times; two unlike rows of an id in two sources."""
    rows = [(7, f"w{i} " * (1 + i % 9), "en", "one id", i) for i in range(1500)]
    rows += [(None, f"w{i} " * (1 + i % 7), "en", "no id", i) for i in range(1500)]
    rows += [(8, "same words here", "en", "one row", 0)] * 1500
    rows += [(i, "w " * 5, "en", None, 0) for i in range(100, 1600)]
    return rows + [(100, "of another source", "en", "one id", 0), (100, None, "en", "one id", 0)]


@pytest.mark.parametrize("written", [True, False])
def test_rows_of_one_id_are_drawn_one_by_one(spark, tmp_path, written):
    rows = repeated_ids()
    docs = frame(spark, rows, SCHEMA, tmp_path if written else None, CLASHING)
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(rows)
    taken = defaultdict(int)
    for r in planned:
        taken[r.source, r.target] += r["size"] * r.copies
    assert len(taken) == 4 and {s for s, _ in taken} == {"one id", "no id", "one row", None}
    for (_, target), words in taken.items():
        assert target > 0 and abs(words - target) < 0.05 * target
    again = mixing.plan(docs.repartition(7)).collect()
    assert Counter(map(str, again)) == Counter(map(str, planned))


def test_repeated_ids_equal_the_sql(spark, tmp_path):
    docs = repeated_ids()
    frame(spark, docs, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op1_mix_sources(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = "doc_id, size, source_size, target, taken"
    wanted = con.execute(f"SELECT {columns} FROM ({mixing.SQL})").fetchall()
    assert Counter(tuple(r) for r in got.select(*columns.split(", ")).collect()) == Counter(wanted)


def test_numbers_of_equal_ids_do_not_depend_on_size_checks(spark, tmp_path, monkeypatch):
    docs = frame(spark, repeated_ids(), SCHEMA, tmp_path)
    planned = Counter(map(str, mixing.plan(docs).collect()))
    monkeypatch.setattr("panelwatch.operators.keys.ONE_TASK_ROWS", 0)
    monkeypatch.setattr("panelwatch.operators.lookup.fits_broadcast", lambda dim: False)
    assert Counter(map(str, mixing.plan(docs).collect())) == planned


def test_mixing_nothing(spark):
    assert mixing.plan(frame(spark, [], SCHEMA)).count() == 0
    wordless = mixing.plan(frame(spark, [(1, None, None, None, None), (2, " ", "en", "a", 1)], SCHEMA)).collect()
    assert [(r.target, r.copies) for r in wordless] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("written", [True, False])
def test_shards_hold_every_row_once_in_gapless_slots(spark, tmp_path, written):
    docs = frame(spark, documents(), SCHEMA, tmp_path if written else None, CLASHING)
    out = sharding.shuffled(docs, shards=16, bucket_bytes=40_000).collect()
    key = lambda r: (r.doc_id, r.text, r.lang, r.source, r.n_chars)
    assert Counter(map(key, out)) == Counter(documents())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shuffle_is_the_same_again_and_differs_by_seed(spark, tmp_path):
    docs = frame(spark, [(i, f"t{i}", "en", "a", 0) for i in range(500)], SCHEMA, tmp_path)
    place = lambda **o: {r.doc_id: (r.shard, r.slot) for r in sharding.shuffled(docs, bucket_bytes=500, **o).collect()}
    first = place()
    assert first == place() and first != place(seed=21)
    # Neighbours are torn apart: the mean distance of random places among n is n / 3.
    order = sorted(first, key=first.get)
    at = {d: i for i, d in enumerate(order)}
    assert sum(abs(at[i] - at[i + 1]) for i in range(499)) / 499 > 500 / 4


def test_equal_rows_are_spread_over_buckets_without_a_second_shuffle_of_texts(spark, tmp_path):
    docs = frame(spark, [(1, "same " * 50, "en", "a", 0)] * 900, SCHEMA, tmp_path)
    plan = sharding.shuffled(docs, bucket_bytes=5000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 1 and "text" not in text.split("ENSURE_REQUIREMENTS")[-1].split("\n")[0]
    buckets = Counter(r.shard for r in plan.collect())
    assert sum(buckets.values()) == 900 and max(buckets.values()) <= 57


def test_written_shards_read_back(spark, tmp_path):
    docs = frame(spark, documents(), SCHEMA, tmp_path)
    back = sharding.write_shards(docs, str(tmp_path / "shards"), shards=4)
    assert back.count() == len(documents()) and {r.shard for r in back.collect()} == {0, 1, 2, 3}
    assert sharding.shuffled(frame(spark, [], SCHEMA)).count() == 0


def test_buckets_count_all_columns(spark, tmp_path):
    rows = [(i, "t", "en", "a", 0) for i in range(400)]
    wide = frame(spark, rows, SCHEMA, tmp_path).withColumns(
        {"payload": F.repeat(F.lit("x"), 1000), "tags": F.array(F.lit("y" * 490)), "gone": F.lit(None).cast("string")}
    )
    width = {r[0] for r in wide.select(sharding.width_of(wide)).collect()}
    assert width == {8 * 8 + len("t" "en" "a") + 1000 + len('{"tags":["') + 490 + len('"]}')}
    out = sharding.shuffled(wide, bucket_bytes=50_000)
    per_task = Counter(r[0] for r in out.select(F.spark_partition_id()).collect())
    assert sum(per_task.values()) == 400 and len(per_task) >= 12 and max(per_task.values()) < 80
    none = frame(spark, [], SCHEMA).withColumn("payload", F.lit(None).cast("binary"))
    assert sharding.shuffled(none).count() == 0
