import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import xxhash
from llm_data import CLASHING, SCHEMA, documents, frame, text

from panelwatch.llm import decontamination, language, secrets, simhash, substrings

# Operator 4


def brute_spans(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        spans = []
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        out.append([tuple(s) for s in spans])
    return out


def spans_of(spark, tmp_path, texts, length, block, extra=None):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    found = substrings.repeated_spans(frame(spark, rows, SCHEMA, tmp_path, extra), length, block).collect()
    by_id = {r.doc_id: [(s.start, s.end) for s in r.removed] for r in found}
    assert len(found) == len(texts)
    return [by_id[i] for i in range(len(texts))]


def test_repeated_bytes_equal_brute_force(spark, tmp_path):
    r = random.Random(5)
    passage, other = text(50, 30), text(51, 60)
    texts = [
        None, "", "ab" * 100, "x" * 300, passage, "pre " + passage + " post", passage[3:] + other, other + "é" + other[:90],
        text(52, 100), text(52, 100), "é" * 70, "1" + "é" * 70, passage[:63], passage[:64], text(1, 3000), "z" + text(1, 3000),
    ]
    for _ in range(20):
        a, b = sorted(r.sample(range(len(other)), 2))
        texts.append(text(r.random(), r.randrange(20)) + other[a:b] + text(r.random(), r.randrange(20)))
    assert spans_of(spark, tmp_path, texts, 64, 5, CLASHING) == brute_spans(texts, 64)


def test_substrings_of_pieces_of_long_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 300)
    monkeypatch.setattr(substrings, "_ROOM", 4000)
    texts = [text(1, 500), text(2, 300) + text(1, 500)[700:2100], text(2, 40), text(3, 700) * 2]
    assert spans_of(spark, tmp_path, texts, 40, 1) == brute_spans(texts, 40)


def test_kept_bytes_and_empty_table(spark, tmp_path):
    docs = frame(spark, documents(), SCHEMA, tmp_path)
    found = substrings.repeated_spans(docs)
    kept = found.withColumn("kept", substrings.kept_bytes("text", "removed")).collect()
    assert len(kept) == len(documents())
    expected = brute_spans([d[1] for d in documents()], 400)
    cut = Counter()
    for (i, t, *_), spans in zip(documents(), expected, strict=True):
        data, at, out = (t or "").encode(), 0, b""
        for s, e in spans:
            out, at = out + data[at:s], e
        cut[i, out + data[at:]] += 1
    assert Counter((r.doc_id, bytes(r.kept)) for r in kept) == cut
    assert substrings.repeated_spans(frame(spark, [], SCHEMA)).count() == 0


# Operator 5


def brute_similarity(window, item):
    def grams(ws):
        k = min(5, len(ws))
        return Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))

    a, b = grams(window), grams(item)
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def brute_contaminated(doc, items):
    ws = (doc or "").lower().replace("!", " ").replace(".", " ").split()
    best = {}
    for item, t in items:
        it = (t or "").lower().replace("!", " ").replace(".", " ").split()
        if it and ws and item is not None:
            n = len(it)
            best[item] = max(brute_similarity(ws[s : s + n], it) for s in range(max(1, len(ws) - n + 1)))
    return {i: s for i, s in best.items() if s >= 0.8}


def test_contaminated_documents_equal_brute_force(spark, tmp_path):
    items = [(i, text(200 + i, 20 + 20 * i)) for i in range(8)] + [(20, "Word"), (21, ""), (22, None), (23, "just three words")]
    passages = [t for _, t in items if t]
    rows = documents()
    r = random.Random(3)
    for i in range(40):
        words = passages[i % 8].split()
        for _ in range(i % 4):
            words[r.randrange(len(words))] = "edited"
        if i % 5 == 0:
            words.insert(len(words) // 2, "extra")
        body = " ".join(words).upper() + "!"
        rows.append((1000 + i, f"{text(i, 30)}\n{body} {text(i + 70, 30)}", "en", "a", 0))
    rows += [(2000, "a word. alone", "en", "a", 0), (2001, "Just, THREE words", "en", "a", 0)]
    rows = [(i, (t or "").replace(",", " ") if t is not None else None, *rest) for i, t, *rest in rows]
    docs = frame(spark, rows, SCHEMA, tmp_path, CLASHING)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.report(docs, bench).collect()
    assert len(got) == len(rows)
    by_id = {x.doc_id: x for x in got}
    flagged = 0
    for i, t, *_ in rows:
        found = brute_contaminated(t, items)
        row = by_id[i]
        assert (row.contaminated, row.n_items) == (bool(found), len(found)), (i, found)
        if found:
            flagged += 1
            assert row.similarity == pytest.approx(max(found.values()))
    assert 15 < flagged < 45
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    clean = [i for i, t, *_ in rows if not brute_contaminated(t, items)]
    assert Counter(x.doc_id for x in kept.collect()) == Counter(clean)


def test_empty_benchmark_leaves_all_documents(spark):
    docs = frame(spark, documents(), SCHEMA)
    none = spark.createDataFrame([(1, None), (2, " ")], "item_id bigint, text string")
    assert decontamination.clean(docs, none).count() == len(documents())
    assert decontamination.report(frame(spark, [], SCHEMA), none).count() == 0


def test_native_simhash_is_that_of_its_shingles(spark):
    grams = ["a b c d e", "b c d e f", "a b c d e"]
    df = spark.createDataFrame([(grams,)], "g array<string>")
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    got = df.select(decontamination.simhash(df.g)).first()[0]
    assert got % (1 << 64) == expected


# Operator 6


@pytest.mark.parametrize(("order", "cells"), [(0, 4096), (2, 1 << 20), (4, 1 << 20), (4, 1500), (6, 1 << 20)])
def test_code_lengths_are_those_of_the_context_tree(spark, order, cells):
    taught = [("en", text(i, 30)) for i in range(6)] + [("xx", "βγδ αβγ βββ"), ("xx", "γγ δδ"), ("xx", ""), ("xx", "γ")]
    labelled = spark.createDataFrame([(t, lang) for lang, t in taught], "text string, lang string")
    model = language.train(labelled, order, cells)
    assert model.languages == ["en", "xx"]
    trees = {}
    for lang, s in taught:
        counts = trees.setdefault(lang, [defaultdict(Counter) for _ in range(order + 1)])
        data = [256] * order + list(s.encode())
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[k][tuple(data[i - k : i])][data[i]] += 1

    def entries(least):
        return sum(len(c) for t in trees.values() for k in t for ctx, c in k.items() if not ctx or sum(c.values()) >= least)

    least = 1
    while 2 * entries(least) > cells and least < 1 << 20:
        least *= 2
    assert (least > 1) == (cells == 1500)

    def bits(lang, t):
        total, data = 0.0, [256] * order + list(t.encode())
        for i in range(order, len(data)):
            for k in range(order, -1, -1):
                ctx = tuple(data[i - k : i])
                seen = trees[lang][k][ctx]
                n, d = sum(seen.values()), len(seen)
                if ctx and n < least:
                    continue
                if seen[data[i]]:
                    total -= math.log2(seen[data[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
            else:
                total += 8
        return total

    probes = ["", "a", text(3, 40), "βγδ", "mixed βγδ text \x00 ü", "𝒳𝒳"]
    got = language.code_lengths(model, pa.array(probes))
    for k, lang in enumerate(model.languages):
        assert list(got[k]) == pytest.approx([bits(lang, t) for t in probes], rel=1e-5, abs=1e-3)


def test_too_many_languages_for_the_tree_are_an_error(spark):
    labelled = spark.createDataFrame([("text", f"l{i}") for i in range(5)], "text string, lang string")
    with pytest.raises(ValueError, match="at most 4 languages"):
        language.train(labelled, 4, 256 * 16)


def test_pieces_do_not_change_what_is_counted_and_code_lengths(spark, monkeypatch):
    taught = [("abc abd", "a"), ("", "a"), ("b", "a"), ("cab cab", "b"), ("é", "b")]
    labelled = spark.createDataFrame(taught, "text string, lang string")
    model, texts = language.train(labelled), pa.array(["abcabc", "", "a", None, "cab" * 20])
    whole = language.code_lengths(model, texts)
    batch = pa.RecordBatch.from_pydict({"lang": [lang for _, lang in taught], "text": [t for t, _ in taught]})

    def counted():
        sums = Counter()
        for rows in language._counter(4)(iter([batch, batch])):
            for r in rows.to_pylist():
                sums[r["lang"], r["string"]] += r["n"]
        return sums

    at_once = counted()
    for size in (1, 3, 5):
        monkeypatch.setattr(language, "_PIECE", size)
        monkeypatch.setattr(language, "_HELD", size)
        assert language.code_lengths(model, texts) == pytest.approx(whole)
        assert counted() == at_once


def test_languages_of_one_script_of_three_bytes_are_told_apart(spark):
    # The same characters, as often, and the same byte triples within them; only their succession differs.
    chars = "あいうえおかきくけこ"
    rng = random.Random(5)

    def said(step):
        at = [rng.randrange(10)]
        for _ in range(30):
            at.append((at[-1] + (step if rng.random() < 0.8 else rng.randrange(10))) % 10)
        return "".join(chars[a] for a in at)

    taught = [(said(step), lang) for step, lang in ((1, "up"), (3, "leap")) for _ in range(200)]
    labelled = spark.createDataFrame(taught, "text string, lang string")
    probes = [(said(step), lang) for step, lang in ((1, "up"), (3, "leap")) for _ in range(100)]

    def right(order):
        judged = language.judge(language.train(labelled, order), pa.array([t for t, _ in probes]))
        return sum(p == lang for p, (_, lang) in zip(judged.field("lang_pred").to_pylist(), probes, strict=True))

    assert right(4) >= 190 > 150 > right(2)


def test_prediction_of_defined_cases(spark, tmp_path):
    docs = frame(spark, documents(), SCHEMA, tmp_path, CLASHING)
    predicted = language.predictor(spark, language.train(docs))
    got = docs.select("doc_id", "text", predicted("text").alias("p")).collect()
    assert len(got) == len(documents())
    for r in got:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == (not lettered)
        assert r.p.lang_pred in ("und", "en", "fr", "de") and 0 <= r.p.score <= 1
    nothing = language.predictor(spark, language.train(frame(spark, [], SCHEMA)))
    assert {r[0] for r in docs.select(nothing("text")["lang_pred"]).collect()} == {"und"}


def test_held_out_follows_the_checksum(spark):
    df = spark.createDataFrame([(i,) for i in [None, *range(-3, 200)]], "doc_id bigint")
    for r in df.select("doc_id", language.held_out(df.doc_id).alias("out")).collect():
        assert r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


# Operator 8


def brute_print(t):
    words = (t or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_those_of_the_contract(monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 7)
    for _, t, *_ in documents():
        if len(t or "") < 10_000:
            assert simhash.fingerprint(t) == brute_print(t)


def brute_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 2 and find(p) != find(q):
                root[max(find(p), find(q))] = min(find(p), find(q))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("crowd", [1, 64])
def test_links_join_all_near_fingerprints(spark, crowd):
    r = random.Random(8)
    prints = {0, -1, 1 << 63, 3 << 62}
    for _ in range(12):
        p = r.getrandbits(64)
        for _ in range(25):  # chains of small steps, and fingerprints near a common one
            p ^= 1 << r.randrange(64) if r.random() < 0.5 else 0
            prints.add(p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    prints = sorted({p % (1 << 64) - (1 << 64 if p % (1 << 64) >> 63 else 0) for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    from panelwatch.llm.graph import components

    roots = {x.node: x.root for x in components(simhash.links(df, crowd)).collect()}
    unsigned = brute_roots([p % (1 << 64) for p in prints])
    groups = lambda of: {frozenset(p for p in prints if of(p) == k) for k in {of(p) for p in prints}}
    assert groups(lambda p: roots.get(p, p)) == groups(lambda p: unsigned[p % (1 << 64)])


def test_components_of_a_long_path(spark):
    from panelwatch.llm.graph import components

    n = 60
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(100, 101), (7, 7)], "u bigint, v bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n)}, 101: 100}
    assert components(edges.where("false")).count() == 0


def test_classes_and_representatives(spark, tmp_path):
    docs = frame(spark, documents(), SCHEMA, tmp_path, CLASHING)
    got = simhash.classes(docs).collect()
    assert len(got) == len(documents())
    prints = {brute_print(t) if len(t or "") < 10_000 else simhash.fingerprint(t) for _, t, *_ in documents()}
    roots = brute_roots(sorted(prints))
    members = defaultdict(list)
    for i, t, *_ in documents():
        members[roots[simhash.fingerprint(t)]].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    for r in got:
        assert r.component == least[roots[r.fp % (1 << 64)]]
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.representatives(frame(spark, [], SCHEMA)).count() == 0


# Operator 9


def brute_base(t):
    import re

    out = []
    for m in re.finditer(
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t,
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


TOKEN = "aB3dE6gH9jK2mN5pQ8sT1vW4"


def test_secret_spans_of_defined_cases(spark, tmp_path):
    secret_texts = [
        'é password: "hunter22" and TOKEN=abc', "secret:token = hunter22", "apikey = short api_key:'longer-value'", "AKIA" + "A" * 16,
        "AKIAshort AKIA" + "B1" * 20, "f" * 24 + " " + "0" * 23, "paſſword: notascii1", "token = " + "a" * 30 + "Z", "x" * 1000,
    ]
    rows = documents() + [(500 + i, t, "en", "a", 0) for i, t in enumerate(secret_texts)]
    docs = frame(spark, rows, SCHEMA, tmp_path, CLASHING)
    got = secrets.scan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in secrets.BASE)
        assert base == brute_base(r.text or "")


def test_weak_parts_are_linked_only_with_complements():
    kinds = lambda t: [k for _, _, k in secrets.find(t)]
    assert kinds(f"user = alice {TOKEN}") == ["identifier", "secret"]
    assert kinds(f"see https://db.example.net/x {TOKEN}") == ["endpoint", "secret"]
    assert kinds(f"only {TOKEN}") == kinds("user = alice at https://db.example.net") == []
    assert kinds(f"user = alice {'far ' * 60}{TOKEN}") == []
    assert kinds("password=hunter22 login: bob") == ["assign", "identifier"]
    near, far = "user = a12" + " " * 200 + TOKEN, "user = a12" + " " * 201 + TOKEN
    assert kinds(near) == ["identifier", "secret"] and kinds(far) == []


def test_secret_query_digests(spark, tmp_path):
    rows = [(1, "password: hunter22", "en", "a", 0), (2, None, "en", "a", 0), (3, "", "en", "a", 0)]
    frame(spark, rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in secrets.op9_secrets(spark, str(tmp_path)).collect()}
    assert (got[1].n_assign, got[1].spans) == (1, "assign:0:18")
    assert got[1].base_sha256 == hashlib.sha256(b"assign:0:18").hexdigest()
    assert got[2].base_sha256 == got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
