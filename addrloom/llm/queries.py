"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.llm import (
    content_sort,
    embedding_dedup,
    fill_in_middle,
    gated_lm,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    source_divergence,
    substring_dedup,
    token_output,
    toxicity,
    voronoi_topk,
)
from addrloom.session import name_local_shared, shared_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Only a local session that names no shared folder gets one here.
        name_local_shared(spark, os.path.join(tempfile.gettempdir(), "addrloom-llm"))
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort.duplicate_groups(docs, keep="largest")


@query
def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken_words(docs)


@query
def op10_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id goes with remainder 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % divisor


@query
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score_documents(docs, labels, usable=remainder(5) != 0)
    return scored.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = line_dedup.remove_common_lines(docs)
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op6_token_output(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_output.write_training_order(docs, shared_path(spark, "token-shards"), continuous=True)


@query
def op4_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.embedding_classes(table(spark, sf_dir, "embeddings"))


@query
def op5_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = gated_lm.score_documents(docs, train=remainder(7) != 2)
    return scored.select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = fill_in_middle.fill_in_middle(docs)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored().cast("binary"), 256).alias("restored_sha256"),
    )


@query
def op12_exact_topk_search(spark, sf_dir):
    return voronoi_topk.top_products(
        table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0
    )


@query
def op13_source_divergence_audit(spark, sf_dir):
    return source_divergence.audit_sources(
        table(spark, sf_dir, "documents").select("text", "lang", "source")
    )
