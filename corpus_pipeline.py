"""The corpus pipeline: documents in, a mixed training set out. Each stage calls one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import lines, mixing, quality, simhash, winnow
from vacancia.llm.common import keep, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the boilerplate lines of their source."""
    clean = lines.drop_boilerplate(docs, host="source", ratio=0.01)
    kind = clean.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs, shingle=3, pivots=simhash.Pivots(distance=2))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span of 10 words, nor a whole shorter item, with the benchmark."""
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed training set: documents, each as often as its source's target asks for."""
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, most_copies=2.0, seed=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The SimHash, the winnowing and the cascade have no SQL counterpart; see tests/llm.
ORACLE_SQL = None
