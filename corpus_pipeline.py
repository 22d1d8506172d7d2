"""The corpus pipeline: from raw documents to shuffled shards of a mixed, clean corpus.

Every stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import decontamination, language, mixing, sharding, simhash
from panelwatch.session import materialise


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents in a language that was learned stay; those it cannot determine go."""
    predicted = language.predictor(spark, language.train(language.learned_from(docs)))
    judged = predicted("text")["lang_pred"]
    return docs.where(judged != F.lit(language.UNDETERMINED))


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, with its contract's shingles of three words and 2 bits: one document of each class stays,
    that with the least doc_id."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document as often as its source's target weight asks for."""
    return mixing.emit(mixing.plan(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents in random order, dealt to equal shards, with shard and slot."""
    return sharding.shuffled(docs)


STAGES = [
    ("language", identify),
    ("near_dedup", dedupe),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Language prediction, fingerprints and the shuffle are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents below `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
