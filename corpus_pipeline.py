"""A corpus pipeline over ``documents``: toxicity, exact and near duplicates, packing.

Each stage takes all rows its predecessor kept and returns a DataFrame; all but the last return the
columns of ``documents``. Null texts count as empty and null ids as documents of their own, as the
operators' docstrings define; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from featurespark.llm import content_sort, gray_simhash, residual_packing, toxicity
from featurespark.session import materialize

# Near duplicates: words of a shingle, and bits in which linked fingerprints differ at most.
SHINGLE_WORDS = 4
RADIUS = 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest id."""
    return content_sort.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest id."""
    return gray_simhash.drop_near_duplicates(docs, shingle_words=SHINGLE_WORDS, radius=RADIUS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return residual_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack),
]

# A fitted classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
