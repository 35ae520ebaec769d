"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept. The first three drop documents, the
fourth masks secrets in the texts, the last packs the tokens. ``run`` applies them to
the table documents, with every stage's result stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewarden.functions.shared import computed_once
from gatewarden.llm.minhash_dedup import without_near_duplicates
from gatewarden.llm.packing import pack_documents
from gatewarden.llm.quality_classifier import good_documents
from gatewarden.llm.quality_rules import kept_documents
from gatewarden.llm.secret_scan import without_secrets

#: Learned rules, a fitted classifier and a genetic search cannot be written in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a fixed nor a learned rule rejects."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their sites' rates call good.

    It learns from the whole table: the rules may have dropped all bad examples.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, labels, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies."""
    return without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents' tokens with its sequence and place there."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = computed_once(docs)
    return docs
