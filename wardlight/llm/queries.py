"""The numbered operators as named queries over a test directory, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardlight.llm.bpe import bpe_table
from wardlight.llm.clustering import cluster_table
from wardlight.llm.divergence import divergence
from wardlight.llm.language import language_table
from wardlight.llm.language_model import score_documents
from wardlight.llm.licenses import license_table
from wardlight.llm.linededup import line_table
from wardlight.llm.mixing import mix_table
from wardlight.llm.oracles import ORACLES  # noqa: F401
from wardlight.llm.packing import pack
from wardlight.llm.parity_join import similarity_classes
from wardlight.llm.privacy import privacy_table
from wardlight.llm.quality import quality_table
from wardlight.llm.search import nearest_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(_table(spark, sf_dir, "documents"))


def op2_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_table(_table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(_table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy_table(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_table(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_table(spark, sf_dir, "documents"),
                public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_table(_table(spark, sf_dir, "embeddings"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_table(_table(spark, sf_dir, "documents"))


def op10_log_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_table(_table(spark, sf_dir, "documents"),
                     public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_table(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_similar_documents, op2_repeated_lines, op3_language, op4_personal_data, op5_quality,
        op6_pack_sequences, op7_nearest_vectors, op8_mix_sources, op9_licenses,
        op10_log_probability, op11_source_divergence, op12_byte_bpe,
        op13_centroid_clusters)}
