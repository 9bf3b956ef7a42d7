"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import documents
from starmart.llm.exact_dedup import exact_dedup
from starmart.llm.filter_audit import audit_filters
from starmart.llm.line_dedup import line_dedup
from starmart.llm.mix import mix_sources
from starmart.llm.ngram_join import ngram_classes
from starmart.llm.pieces import decode_pieces, encode_pieces
from starmart.llm.quality import quality_rules
from starmart.llm.shards import assign_shards
from starmart.llm.spelling import spelling_variants
from starmart.llm.substring_dedup import repeated_passages
from starmart.llm.tokens import count_tokens
from starmart.llm.toxicity import score_toxicity
from starmart.llm.warc import archive_pages


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(documents(spark, sf_dir))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).drop("repeats")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir), 24)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("clean_text")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All piece ids, and the hash of what they decode to."""
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = encode_pieces(documents(spark, sf_dir), path)
    return decode_pieces(encoded, path, carry=True).select(
        "doc_id", "pieces", F.size("pieces").alias("n_pieces"), F.sha2("text", 256).alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), slip_every=199)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_mix_sources, op3_exact_dedup, op4_token_counts, op5_shards, op6_quality_rules,
    op7_pieces, op8_line_dedup, op9_repeated_passages, op10_toxicity, op11_warc,
    op12_filter_audit, op13_spelling_variants)}
