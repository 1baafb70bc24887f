"""Training-data pipeline: quality, near-duplicate lines, near-duplicate documents,
repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import line_dedup, near_join, packing, quality_model, suffix_dedup
from barloom.llm.common import DOCUMENT_COLUMNS, documents, durable, table

# Stages fit models and compare texts pairwise; SQL cannot express them.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[c for c in DOCUMENT_COLUMNS if c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    docs = _columns(docs)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model)
    return scored.filter(F.col("score") >= quality_model.THRESHOLD).drop("score")


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat an earlier one."""
    return line_dedup.without_near_lines(_columns(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of near duplicates."""
    docs = _columns(docs)
    found = near_join.near_components(docs)
    gone = found.filter("component_id != doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without long strings that occur more than once."""
    return suffix_dedup.without_repeats(_columns(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(docs, ranks, public_tokenizers.PATTERN, vocabulary)
    return packing.pack(durable(pieces))


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", fresh_lines),
    ("ngram_jaccard_join", one_of_each),
    ("suffix_array_dedup", fresh_passages),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on the stored result of the one before."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
