"""A corpus pipeline in five stages, each one operator of ``starmart.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns they were given. Rows that share an id are one document here: they
stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import documents, text_or_empty, word_count
from starmart.llm.exact_dedup import exact_dedup
from starmart.llm.mix import mix_sources
from starmart.llm.ngram_join import ngram_classes
from starmart.llm.pieces import encode_pieces
from starmart.llm.quality import judge_quality
from starmart.llm.queries import tokenizer_path
from starmart.operators.joins import checked_broadcast
from starmart.session import materialize


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _only_firsts(docs: DataFrame, decisions: DataFrame, first_col: str) -> DataFrame:
    """``docs`` without those whose id is not the ``first_col`` of their group."""
    ids = materialize(decisions.select(F.col("doc_id").alias("gone_id"), F.col(first_col).alias("first_id")), "stage-ids")
    stays = F.col("gone_id").eqNullSafe(F.col("first_id"))
    staying = ids.where(stays).select(F.col("gone_id").alias("stay_id")).distinct()
    gone = materialize(ids.where(~stays).select("gone_id").distinct().join(
        staying, F.col("gone_id").eqNullSafe(F.col("stay_id")), "left_anti"), "stage-gone")
    return docs.join(checked_broadcast(gone), docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without their failed lines."""
    name = _free_name(docs, "quality")
    # the explode keeps the filter above the rules, which thus run once a row
    judged = judge_quality(docs, "text", result=name).withColumn(name, F.explode(F.array(name))).where(F.col(name)["kept"])
    clean, changed = F.col(name)["clean_text"], F.col(name)["clean_text"] != F.col("text")
    new = {"text": clean, "n_chars": F.when(changed, F.length(clean).cast("long")).otherwise(F.col("n_chars"))}
    return judged.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _only_firsts(docs, exact_dedup(docs), "keep_id")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _only_firsts(docs, ngram_classes(docs, count_links=False), "class_id")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mix_sources(docs, keep_source=True)
    # rows alike in id, source and size are taken alike
    times = materialize(taken.groupBy(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"),
                                      F.col("size").alias("mix_size"))
                        .agg(F.max("repeats").alias("mix_repeats")), "stage-mix").where("mix_repeats > 0")
    alike = (F.col("doc_id").eqNullSafe(F.col("mix_id")) & F.col("source").eqNullSafe(F.col("mix_source"))
             & (word_count(text_or_empty("text")) == F.col("mix_size")))
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    return (plain.join(checked_broadcast(times), alike)
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "mix_repeats"))).select("row.*"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training examples: piece ids under seeded merge dropout, drawn anew for
    each copy of a document."""
    same = W.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    numbered = docs.select("doc_id", "text", F.row_number().over(same).alias("copy"))
    return (encode_pieces(numbered, tokenizer_path("piece_bpe_32k.model"), copy_col="copy")
            .withColumn("n_pieces", F.size("pieces")))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing sources", mix), ("SentencePiece encoding", pieces)]

# MinHash classes and merge dropout have no SQL form; tests/llm checks the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
