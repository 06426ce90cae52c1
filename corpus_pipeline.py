"""A training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept; its result is written as Parquet and read again. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voltide.llm.chaining import drop_passages
from voltide.llm.common import scratch_path, table
from voltide.llm.divergence import keep_documents
from voltide.llm.packing import pack_documents
from voltide.llm.simhash import drop_near_duplicates
from voltide.session import job


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose characters and words are like a language's."""
    return keep_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: five-word shingles, Jaccard 0.8 or more."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that one with a smaller id has."""
    return drop_passages(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(docs, path, ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Tokens and fuzzy passages are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each one's result stored; what they store on the way goes."""
    result = scratch_path(spark, "pipeline")
    with job(spark):
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            path = scratch_path(spark, name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        STAGES[-1][1](spark, docs, sf_dir).write.parquet(result)
    return spark.read.parquet(result)
