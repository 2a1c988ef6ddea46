"""The training-data pipeline: five stages over ``documents``, in order.

Quality rules and toxicity drop the documents they reject, SimHash keeps one
document of each group of near-duplicates, decontamination drops documents
that hold benchmark passages, and the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import bpe, common, decontaminate, quality, simhash, toxicity


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, common.table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.filter_documents(docs, common.table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.filter_documents(docs, common.table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_table(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

#: the stages learn from labels, hash shingles and run byte-pair merges, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
