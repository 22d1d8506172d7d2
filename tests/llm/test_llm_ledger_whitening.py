"""Operators 12 and 13 against plain Python and numpy."""

import re
from collections import Counter

import numpy as np
import pytest
from llm_data import CLASHING, SCHEMA, documents, frame

from panelwatch.llm import eigen, ledger, whitening

# Operator 12


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def brute_failures(n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words):
    failed = [
        n_words < 50,
        100 * n_repeat_words > 50 * n_words,
        10 * n_symbols > n_words,
        n_lines >= 5 and 2 * n_dup_lines > n_lines,
        word_chars < 1.5 * n_words,
    ]
    return sum(1 << i for i, f in enumerate(failed) if f)


ODD = [
    (70, "a b c " * 40, None, None, None),
    (71, "a b c a b", None, None, None),
    (72, "a a a a", None, None, None),
    (73, "x y\nx y\n\n \nx y\r\n", None, None, None),
    (74, "# * $ %% && |<> 𝒳 é\x00z", None, None, None),
    (75, "one two three four " * 3 + " ".join(f"w{i}" for i in range(90)) + " two three four", None, None, None),
    (76, "same line of words\n" * 30 + " ".join(f"w{i}" for i in range(900)), None, None, None),
    (77, "a b " * 50 + "#" * 300, None, None, None),
]


@pytest.mark.parametrize("extra", [None, {**CLASHING, "Failures": "int", "n_words": "int", "doc": "int"}])
def test_ledger_equals_plain_python(spark, extra):
    rows = [*documents(), *ODD]
    names = "doc_id text lang source n_chars".split()
    got = ledger.ledger(frame(spark, rows, SCHEMA, None, extra)).select(*names, *ledger.MEASURES, ledger.FAILURES).collect()
    expected = Counter((*r, *brute_measures(r[1]), brute_failures(*brute_measures(r[1]))) for r in rows)
    assert Counter(map(tuple, got)) == expected


def test_policies_are_versioned_and_read_bits_only(spark):
    rows = [*documents(), *ODD]
    book = ledger.ledger(frame(spark, rows, SCHEMA)).select("doc_id", "failures", "n_words")
    for policy in (*ledger.POLICIES, ledger.Policy("loose", 1, ("short", "symbols"), tolerated=1)):
        mask = ledger.mask_of(policy)
        kept = Counter(r.doc_id for r in book.where(ledger.keeps(policy)).collect())
        bits = [(r[0], (brute_failures(*brute_measures(r[1])) & mask).bit_count()) for r in rows]
        assert kept == Counter(i for i, n in bits if n <= policy.tolerated)
    assert ledger.newest("web").version == 2
    with pytest.raises(KeyError):
        ledger.mask_of(ledger.Policy("wrong", 1, ("no such rule",)))


def test_ablations_equal_plain_counts(spark):
    rows = [*documents(), *ODD]
    book = ledger.ledger(frame(spark, rows, SCHEMA))
    found = {(r.policy, r.version, r.rule): r for r in ledger.ablations(book).collect()}
    assert len(found) == sum(len(p.rules) for p in ledger.POLICIES)
    judged = [(m[0], brute_failures(*m)) for m in (brute_measures(r[1]) for r in rows)]
    for policy in ledger.POLICIES:
        mask = ledger.mask_of(policy)
        for place, rule in enumerate(ledger.RULES):
            if rule.name not in policy.rules:
                continue
            bit, r = 1 << place, found[policy.name, policy.version, rule.name]
            failed = [n for n, f in judged if f & bit]
            regained = [n for n, f in judged if f & mask == bit]
            kept = [n for n, f in judged if not f & mask]
            assert (r.docs_failed, r.words_failed) == (len(failed), sum(failed))
            assert (r.docs_regained, r.words_regained) == (len(regained), sum(regained))
            assert (r.docs_kept, r.words_kept) == (len(kept), sum(kept))


def test_ledger_of_nothing(spark):
    book = ledger.ledger(frame(spark, [], SCHEMA))
    assert book.count() == 0
    assert all(r.docs_kept == 0 for r in ledger.ablations(book).collect())


# Operator 13


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
def test_eigenpairs_equal_numpy(size):
    x = np.random.default_rng(size).standard_normal((90, size))
    matrix = x.T @ x
    values, vectors = eigen.leading(matrix, 4)
    expected = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert np.allclose(values, expected, rtol=1e-13, atol=0)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * values[0])


@pytest.mark.parametrize("values", [[3, 3, 3, 3, 1, 0], [5, 5 - 1e-12, 5 - 2e-12, 4, 4, 4, 1], [7, 1e-9, 1e-9, 0, 0, 0], [1, 0, 0], [0, 0, 0]])
def test_clusters_have_orthogonal_vectors(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values),) * 2))
    for matrix in (np.diag(np.array(values, float)), q @ np.diag(np.array(values, float)) @ q.T):
        found, vectors = eigen.leading(matrix, 4)
        assert np.allclose(found, values[:4], atol=1e-12 * (values[0] or 1))
        assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
        assert np.allclose(matrix @ vectors, vectors * found, atol=1e-12 * (values[0] or 1))


VECTORS = "vec_id bigint, embedding array<float>, label int"


def vectors_of(seed, n=150, d=6):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d)) * np.arange(1, d + 1) + 3
    return [(i, [float(np.float32(v)) for v in row], 0) for i, row in enumerate(x)]


def brute(rows, k=4):
    usable = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(v) for _, v in usable), default=0)
    numbers = [(i, tuple(int(np.floor(256 * c)) for c in v) + (0,) * (d - len(v))) for i, v in usable]
    fit = sorted({x for _, x in numbers})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = []
    for i, x in numbers:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        row = np.array([float(n * c - s) / n for c, s in zip(x, sums, strict=True)])
        out += [(i, j + 1, n, deviation, (row @ vectors[:, j]) / np.sqrt(e), e / covariance.trace()) for j, e in enumerate(values)]
    return out


def assert_like(found, expected):
    assert len(found) == len(expected)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    components = {r[1] for r in expected}
    for c in components:
        a, b = (np.array([r[4] for r in rows if r[1] == c]) for rows in (found, expected))
        sign = np.sign(a @ b)
        assert np.allclose(a, sign * b, rtol=1e-9, atol=1e-9)
    assert np.allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-12)
    assert {r[6] < 1e-9 for r in found} <= {True} and len({r[6] for r in found}) <= 1


def test_whitening_equals_numpy(spark, tmp_path):
    rows = vectors_of(1)
    rows += [(500 + i, rows[7][1], 1) for i in range(60)]  # copies count once in the fit
    rows += [(None, rows[8][1], 1), (9, rows[9][1], None), (9, rows[9][1], None)]
    rows += [(600, None, 0), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (602, [float("nan")] * 6, 0), (603, [float("inf")] * 6, 0)]
    rows += [(604, [1.0, 2.0], 0), (605, [], 0), (606, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0], 0), (607, [-0.0] * 6, 0)]
    extra = {"x": "int", "component": "int", "whitened": "int", "N": "int"}
    found = whitening.whiten(frame(spark, rows, VECTORS, tmp_path, extra)).collect()
    assert_like(found, brute(rows))


def test_a_far_centre_loses_nothing(spark):
    rows = [(i, [2.0**20 + v / 64 for v in x[:3]], 0) for i, x, _ in vectors_of(2)]
    rows = [(i, [float(np.float32(v)) for v in x], 0) for i, x, _ in rows]
    found = whitening.whiten(frame(spark, rows, VECTORS)).collect()
    assert_like(found, brute(rows, 3))


def test_components_without_variance_are_left_out(spark):
    plane = [(i, [float(i % 7), float(i % 5), 1.0, 1.0, 1.0], 0) for i in range(70)]
    found = whitening.whiten(frame(spark, plane, VECTORS)).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 140
    for rows in ([], [(1, None, 0)], [(1, [], 0), (2, [], 0)], [(i, [1.0, 2.0], 0) for i in range(5)]):
        assert whitening.whiten(frame(spark, rows, VECTORS)).count() == 0


def test_huge_numbers_do_not_crash(spark):
    rows = [(i, [float(np.float32(v * 1e30)) for v in x], 0) for i, x, _ in vectors_of(3, 20)] + vectors_of(4, 5)
    found = whitening.whiten(frame(spark, rows, VECTORS)).collect()
    assert len({r.n for r in found}) == 1 and len(found) % 25 == 0
    assert all(r.deviation is None or r.deviation >= 0 for r in found)


def test_deviations_are_exact_up_to_64_bits():
    centre = whitening.Centre(3, (10, -(1 << 33)))
    x = np.array([[1, 2], [1 << 40, 5], [3, 1 << 29]])
    exact = [(3 * int(a) - 10) ** 2 + (3 * int(b) + (1 << 33)) ** 2 for a, b in x]
    assert centre.deviations(x) == [e if e < 1 << 63 else None for e in exact]
