"""Operator 12: quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per failed rule;
policies, each a name, a version and a set of rules, are applied to the stored bits and never touch a text
again. Ablations need only the distinct bit patterns a policy can see, of which there are at most two to
the number of its rules whatever the number of documents: they are counted with a combine before the shuffle, and
bitwise operations on the patterns tell what each rule rejects, and what it alone rejects.

All measures of a document are taken in its own row, so nothing is shuffled for the ledger. Words in
repeated 3-word windows are found by hashes of 64 bits: a text whose hashes are all distinct has none;
in any other they are sorted with their places, and equal neighbours are the repeats. Two different windows
of a text of n words share a hash with a probability of about n squared / 3.7e19.

Defined cases: a null or empty text has no words and fails `short` alone; a null doc_id is returned as it is;
equal rows are rows of their own; a text of fewer than three words has no window; very long texts are
measured whole, their words being one array; an empty table gives no rows, and ablations without rows; extra
columns are kept, except those named like the columns added here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm.common import WORD, packed, without
from panelwatch.session import materialise

# Fixed values of the contract: symbols, and the words of a window.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
FAILURES = "failures"


@dataclass(frozen=True)
class Rule:
    """A name and the SQL condition over the measures under which a document fails."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version of a set of rules; a document is kept if it fails at most `tolerated` of them."""

    name: str
    version: int
    rules: tuple[str, ...]
    tolerated: int = 0


# A rule's bit is its place here, so rules are only ever appended.
RULES = (
    Rule("short", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_lines >= 5 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "10 * word_chars < 15 * n_words"),
)
POLICIES = (
    Policy("base", 1, ("short", "repeated_words")),
    Policy("web", 1, ("short", "repeated_words", "symbols")),
    Policy("web", 2, ("short", "repeated_words", "symbols", "duplicate_lines", "short_words")),
)


def mask_of(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    """The bits of a policy's rules."""
    places = {r.name: i for i, r in enumerate(rules)}
    if len(places) != len(rules) or len(rules) > 63:
        raise ValueError("rules need names of their own, and there are at most 63")
    return sum(1 << places[name] for name in set(policy.rules))


def newest(name: str, policies: Sequence[Policy] = POLICIES) -> Policy:
    """The newest version of a policy."""
    return max((p for p in policies if p.name == name), key=lambda p: p.version)


def measured(docs: DataFrame) -> DataFrame:
    """The documents with their measures, each taken once; nothing moves.

    Steps are selects of their own, as each reads arrays of the one before several times.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = packed(
        without(docs, [*MEASURES, FAILURES]),
        "doc",
        words=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lines=F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        n_symbols=F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
    )
    rows = rows.select(
        "doc",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
    )
    carried = ["doc", *MEASURES[:-1]]
    starts = F.slice("hashed", F.lit(1), F.greatest(F.size("hashed") - F.lit(WINDOW - 1), F.lit(0)))
    window = F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get("hashed", i + k) for k in range(1, WINDOW)]))
    rows = rows.select(*carried, window.alias("windows"))
    several = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    rows = rows.select(*carried, F.when(several, placed).alias("placed"))
    found = F.filter(
        "placed",
        lambda w, k: w["hash"].eqNullSafe(F.get("placed", k - 1)["hash"]) | w["hash"].eqNullSafe(F.get("placed", k + 1)["hash"]),
    )
    rows = rows.select(*carried, F.sort_array(F.transform(found, lambda w: w["place"])).alias("repeats"))
    # A window adds its words up to the next one's first.
    new = F.transform("repeats", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("repeats", k + 1) - at, F.lit(WINDOW))))
    covered = F.aggregate(new, F.lit(0).cast("long"), lambda total, n: total + n)
    return rows.select(*carried, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] | None = None) -> DataFrame:
    """A written table: the documents' columns (those in `keep`, or all) with their measures and `failures`,
    the bits of the rules they fail. As it is written, no policy ever evaluates a rule again.
    """
    mask_of(Policy("all", 0, tuple(r.name for r in rules)), rules)
    rows = measured(docs)
    failures = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        failures = failures.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    added = [*MEASURES, FAILURES]
    names = rows.schema["doc"].dataType.names if keep is None else keep
    kept = rows.withColumn(FAILURES, failures).select(*[F.col("doc").getField(c).alias(c) for c in names], *added)
    return materialise(kept, "ledger")


def _failed(policy: Policy, rules: Sequence[Rule]) -> Column:
    """The bits of the policy's rules that a row of a ledger fails."""
    return F.col(FAILURES).bitwiseAND(F.lit(mask_of(policy, rules)).cast("long"))


def keeps(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a policy keeps a row of a ledger, from its bits alone."""
    return F.bit_count(_failed(policy, rules)) <= policy.tolerated


def ablations(book: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule of each policy does: policy, version, rule, and the documents and words of the ledger
    that fail it (`failed`), that the policy keeps (`kept`), and that it would keep as well without the rule (`regained`).
    """
    counted = book.groupBy(FAILURES).agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"))
    patterns = materialise(counted, "rule_patterns")
    places = {r.name: i for i, r in enumerate(rules)}
    parts = []
    for policy in policies:
        failed = _failed(policy, rules)
        for name in sorted(set(policy.rules), key=places.get):
            bit = F.lit(1 << places[name]).cast("long")
            fails = F.col(FAILURES).bitwiseAND(bit) != 0
            kept = F.bit_count(failed) <= policy.tolerated
            without_it = F.bit_count(failed.bitwiseAND(F.bitwise_not(bit))) <= policy.tolerated
            sums = {"failed": fails, "kept": kept, "regained": ~kept & without_it}
            parts.append(
                patterns.agg(
                    *[
                        F.coalesce(F.sum(F.when(held, F.col(of))), F.lit(0)).alias(f"{of}_{what}")
                        for what, held in sums.items()
                        for of in ("docs", "words")
                    ]
                ).select(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.lit(name).alias("rule"), "*")
            )
    return reduce(DataFrame.unionAll, parts)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    base = newest("base")
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~keeps(base)).alias("base_failed"),
        (keeps(base) & keeps(newest("web"))).alias("kept"),
        "n_lines",
        FAILURES,
    )


def _sql_failures() -> str:
    return " + ".join(f"CASE WHEN {rule.fails} THEN {1 << place} ELSE 0 END" for place, rule in enumerate(RULES))


SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT row, i, concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS w
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
  SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1
), covered AS (
  SELECT row, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM repeated) GROUP BY row
), measured AS (
  SELECT doc_id,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (row)
), judged AS (
  SELECT *, CAST({_sql_failures()} AS BIGINT) AS failures FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, failures,
  (failures & {mask_of(newest("base"))}) != 0 AS base_failed, (failures & {mask_of(newest("base")) | mask_of(newest("web"))}) = 0 AS kept
FROM judged
"""
