"""Operator 3: judge URLs by rules, and by gradient-boosted trees where no rule fits.

A rule is a host and a path; it fits the host and all its subdomains if the URL's path starts with the
rule's, and the longest fitting rule decides. All other URLs are judged by gradient-boosted trees (Spark
ML, in the JVM) on lexical features: lengths, depth, digit ratio, entropy, parameter counts, and how often
labelled URLs of the same host suffix, path head and file ending are blocked.

The trees are fitted on a bounded sample of labelled URLs (`SAMPLE`, those with the least hashes); the
suffix statistics are counted over all labelled URLs. Rates are smoothed towards the overall rate. A URL is
fitted on the rates of the other folds (`FOLDS`, dealt by a hash of the URL, so equal URLs share one): its
own label is in none of its features. Every URL is judged, by the rates of all folds; none is dropped. Suffix
tables are looked up by joins whose size is checked.

Defined cases: a null URL, or one without `://`, has empty host and path, fits no rule and is judged by
the trees like any other; equal URLs are judged alike; if no URL is labelled, the verdict is allow, and if
all labels agree, it is theirs; an empty table gives no rows; extra columns are kept by `judge`, except
those named like the columns added.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm.common import packed, unpacked, without
from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

# Fixed values of the contract: host and path of each rule, and its verdict.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
SAMPLE = 20_000
TREES = 10
DEPTH = 4
FOLDS = 5
PRIOR = 20.0  # labelled URLs that the overall rate counts for
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits; null if none does. Equally long ones are taken by name."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        of_host = (host == name) | F.endswith(host, F.lit(f".{name}"))
        fits.append(F.when(of_host & F.startswith(path, F.lit(slash + rest)), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    return reduce(lambda acc, r: acc.when(rule == r, rules[r]), rules, F.when(F.lit(False), "allow"))


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    each = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(each, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


# Names of the groups whose block rates are features, and what a URL's group is.
def _groups(host: Column, path: Column) -> dict[str, Column]:
    return {
        "_top": F.substring_index(host, ".", -1),
        "_domain": F.substring_index(host, ".", -2),
        "_sub": F.substring_index(host, ".", 1),
        "_head": F.regexp_extract(path, r"^/([^/]*)", 1),
        "_end": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})/?$", 1),
    }


FEATURES = (
    "_length", "_host_length", "_path_length", "_depth", "_labels", "_digits", "_hyphens", "_entropy",
    "_host_entropy", "_params", "_fragment", "_secure",
)
GROUPS = ("_top", "_domain", "_sub", "_head", "_end")


def with_features(urls: DataFrame) -> DataFrame:
    """Add the lexical features and groups of `url`, given `host` and `path`."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    number = {
        "_length": F.length(url),
        "_host_length": F.length(host),
        "_path_length": F.length(path),
        "_depth": _count(path, "/"),
        "_labels": _count(host, ".") + 1,
        "_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "_hyphens": _count(host, "-"),
        "_entropy": _entropy(url),
        "_host_entropy": _entropy(host),
        "_params": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "_fragment": F.contains(url, F.lit("#")).cast("int"),
        "_secure": F.startswith(url, F.lit("https:")).cast("int"),
    }
    return urls.withColumns({k: v.cast("double") for k, v in number.items()} | _groups(host, path))


def _counts(known: DataFrame, group: str) -> DataFrame:
    """Per value of a group: in each fold, the labelled URLs and the blocked ones among them."""
    of = [F.col("_fold") == i for i in range(FOLDS)]
    return known.groupBy(group).agg(
        F.array(*[F.count_if(f).cast("double") for f in of]).alias("_n"),
        F.array(*[F.sum(F.when(f, F.col("_block")).otherwise(0.0)) for f in of]).alias("_b"),
    )


def _with_rates(featured: DataFrame, counts: dict[str, DataFrame], overall: float, but: Column | None = None) -> DataFrame:
    """Add each group's smoothed block rate, counted over all folds `but` one."""

    def total(each: Column) -> Column:
        whole = F.coalesce(F.aggregate(each, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))
        return whole if but is None else whole - F.coalesce(F.get(each, but), F.lit(0.0))

    for group, table in counts.items():
        rate = (total(F.col("_b")) + PRIOR * overall) / (total(F.col("_n")) + PRIOR)
        featured = lookup(featured, table, [group], "left").withColumn(f"{group}_rate", rate).drop("_n", "_b")
    return featured


def judge(
    pages: DataFrame, labelled: DataFrame, rules: dict[str, str], sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH
) -> DataFrame:
    """The pages with host, path, rule and verdict. `labelled` has url and block (0 or 1)."""
    added = ["host", "path", "rule", "verdict"]
    url = F.col("url")
    parsed = packed(without(pages, added), "page", url=url, host=host_of(url), path=path_of(url))
    parsed = parsed.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    by_rule = _verdict_of(F.col("rule"), rules)

    fold = F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS)).cast("int").alias("_fold")
    known = labelled.where("block IS NOT NULL").select("url", F.col("block").cast("double").alias("_block"), fold)
    known = materialise(with_features(known.withColumns({"host": host_of(url), "path": path_of(url)})), "labelled_urls")
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("_block"), F.lit(0.0))).first()
    if blocked in (0, n):
        constant = F.lit("block" if n and blocked == n else "allow")
        return unpacked(parsed.withColumn("verdict", F.coalesce(by_rule, constant)), "page", *added)

    overall = blocked / n
    counts = {group: materialise(_counts(known, group), f"counts{group}") for group in GROUPS}
    assembler = VectorAssembler(inputCols=[*FEATURES, *[f"{g}_rate" for g in GROUPS]], outputCol="_features")
    chosen = known.orderBy(F.xxhash64("url"), "url", "_block").limit(sample)
    rated = _with_rates(chosen, counts, overall, F.col("_fold"))
    fitted = materialise(rated.select("_block", *FEATURES, *[f"{g}_rate" for g in GROUPS]), "sample")
    boosted = GBTClassifier(
        labelCol="_block", featuresCol="_features", predictionCol="_p", maxIter=trees, maxDepth=depth, seed=3
    ).fit(assembler.transform(fitted))

    ready = assembler.transform(_with_rates(with_features(parsed), counts, overall))
    by_trees = F.when(F.col("_p") > 0.5, "block").otherwise("allow")
    return unpacked(boosted.transform(ready).withColumn("verdict", F.coalesce(by_rule, by_trees)), "page", *added)


def labelled_by_rules(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """url and block of the pages that a rule judges."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    verdict = _verdict_of(rule_for(host, path, rules), rules)
    return pages.select("url", F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("block")).where("block IS NOT NULL")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, labelled_by_rules(pages, RULES), RULES).select("page_id", "host", "path", "rule", "verdict")
