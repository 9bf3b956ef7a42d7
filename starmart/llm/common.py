"""Shared column expressions: white space, words, seeded keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space is U+0020 and U+0009..U+000D, a word is a run of
# anything else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(text_col: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a blank one."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_CLASS + "+"))


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body).getItem(0)
