"""A corpus from raw documents to packed sequences: each stage works on all that the one before kept.

Rules are those of the operators: a null or empty text is a document like any other, which no stage but the classifier
drops and which packs as its end token; equal texts keep the row with the smallest id; rows repeated whole count as one
document of a group; columns beside those of ``documents`` pass through until the last stage, whatever their names. An
empty table gives an empty result. A stage's table lies in the shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import ngram_join, packing, quality, substring_dedup
from tillstar.llm.scratch import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained quality classifier does not reject."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_each(docs, gram=5, percent=80)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier document has; ``n_chars`` follows the text."""
    return substring_dedup.rewritten(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeated_passages),
    ("best_fit_packing", packed_sequences),
]

#: The classifier is trained, so no SQL gives these rows; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
