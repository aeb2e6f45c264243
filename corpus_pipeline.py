"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the stage before has written and keeps the columns of ``documents``, but for the
last. The stages are the training-data operators with their production parameters.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from addrloom.llm import content_sort, mixing, ngram_join, packing, toxicity
from addrloom.session import materialise, name_local_shared


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores below 0.5; it learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.accepted(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return content_sort.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar n-gram sets."""
    return ngram_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights, by repeating and leaving out words."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("best-fit packing", pack),
]

# Learning, digests of n-grams and tokenizers are beyond SQL: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only a local session that names no shared folder gets one here.
    name_local_shared(spark, os.path.join(tempfile.gettempdir(), "addrloom-llm"))
    return run(spark, sf_dir)
