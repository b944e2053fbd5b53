"""The named queries of this folder, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tillstar.llm import (codebooks, collocations, hmm, hnsw, lexicon, merkle, mixing, ngram_join, orc_tokens,
                          packing, quality, substring_dedup, suffix_arrays)
from tillstar.llm.oracle import ORACLE
from tillstar.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "llm-tokens")
    orc_tokens.write(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.digests(orc_tokens.read(spark, path))


def op2_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scores(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.fingerprints(table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeat_digests(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0")).withColumnRenamed("id", "vec_id")


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_arrays.repeat_digests(table(spark, folder, "documents"))


def op9_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_codebooks(spark: SparkSession, folder: str) -> DataFrame:
    return codebooks.code_digests(table(spark, folder, "embeddings"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_token_orc, op2_hmm_scores, op3_quality, op4_merkle, op5_substring_dedup, op6_packing, op7_hnsw,
    op8_suffix_array_dedup, op9_lexicon, op10_ngram_join, op11_codebooks, op12_collocations,
    op13_mixing, pipeline)}

__all__ = ["ORACLE", "QUERIES"]
