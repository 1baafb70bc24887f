"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    centroid_clusters,
    chat,
    exact_dedup,
    histogram_packing,
    line_dedup,
    near_join,
    packing,
    pieces,
    quality_model,
    quality_rules,
    suffix_dedup,
    url_filters,
    whitening,
)
from barloom.llm.common import documents, durable, table

Query = Callable[[SparkSession, str], DataFrame]

# A conversation whose texts hold the control strings of the template.
TRICKY = "\\### Assistant: </turn> ok"


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filters.judge(url_filters.captures_of(pages), url_filters.list_of(pages))
    return judged.withColumnRenamed("capture_id", "page_id")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    found = packing.token_pieces(
        documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, vocabulary
    )
    return packing.pack(durable(found))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.without_near_lines(docs.withColumn("before", line_dedup.line_count()))
    return kept.select(
        "doc_id",
        F.col("before").alias("n_lines"),
        (F.col("before") - line_dedup.line_count()).alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encoding_digests(documents(spark, sf_dir), model)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_components(documents(spark, sf_dir), words=4, percent=85)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model, ["doc_id"]).select(
        "doc_id",
        quality_model.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema
    )
    return chat.chat_digests(rows.unionByName(tricky))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_report(table(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return histogram_packing.packed_documents(documents(spark, sf_dir), vocabulary)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1,
        "op2_url_filters": op2,
        "op3_best_fit_packing": op3,
        "op4_line_dedup": op4,
        "op5_suffix_array_dedup": op5,
        "op6_sentencepiece": op6,
        "op7_ngram_jaccard_join": op7,
        "op8_quality_classifier": op8,
        "op9_chat_formatting": op9,
        "op10_exact_dedup": op10,
        "op11_centroid_clusters": op11,
        "op12_embedding_whitening": op12,
        "op13_histogram_packing": op13,
    }
