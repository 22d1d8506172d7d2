"""Small documents with everything that may go wrong in them."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns named like those that operators add, in other cases of letters too.
CLASHING = {
    c: "int"
    for c in (
        "Shard", "slot", "size", "target", "copies", "fp", "FP", "component", "key", "_key", "_row", "removed",
        "spans", "lang_pred", "score", "units", "core", "_f", "host", "rule", "window", "rank", "_bucket", "words",
    )
}


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed"]) for _ in range(n))


def documents():
    """Nulls in every column, empty and long texts, repeated rows, equal and near texts, odd characters."""
    long = text(1, 30_000)
    rows = [
        (0, None, None, None, None),
        (1, "", "en", "a", 0),
        (None, text(2, 80), "en", "a", 1),
        (None, text(2, 80), "en", "a", 1),
        (3, text(3, 120), "en", "b", None),
        (4, text(3, 120), None, "b", 2),
        (4, text(3, 120), None, "b", 2),
        (5, long, "en", "c", 3),
        (6, long[:100_000] + " changed " + long[100_000:], "fr", "c", 3),
        (7, " \t\n\r\x0b\x0c ", "fr", "", 4),
        (8, "é ß 𝒳 \x00 ﬀ İ", "de", "ü", 5),
        (9, "one", "de", "𝒳", 6),
        (10, "1234 !!! ...", "de", "ü", 6),
    ]
    rows += [(11 + i, text(100 + i, 5 + 9 * i), ("en", "fr", "de")[i % 3], f"s{i % 5}", i) for i in range(40)]
    rows += [(60 + i, text(7, 200), "en", "copies", i) for i in range(30)]
    return rows


def frame(spark, rows, schema, tmp_path=None, extra=None):
    """A DataFrame, or a written table if a folder is given, with extra columns."""
    names = list(extra or {})
    # Names that differ in case only cannot be written to one table; the first of each is kept.
    names = list({n.lower(): n for n in names}.values())
    full = schema + "".join(f", {n} {extra[n]}" for n in names)
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], full)
    if tmp_path is None:
        return df
    path = str(tmp_path / "table")
    df.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
