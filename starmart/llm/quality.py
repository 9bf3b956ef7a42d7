"""Quality rules, line first. DataFrame functions only, one pass, no shuffle.

Every line is judged on its own (punctuation, navigation, boilerplate); lines
that fail are removed; a document is rejected if that takes too much of its
text, or if it fails the base rule (too few words, or too many words inside
repeated three-word windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE_CLASS, SPACES, WORD_PATTERN, let, text_or_empty, words

SYMBOL_CLASS = "[#*$%&|<>]"  # fixed value

# The patterns hold no nested repeats, so matching is linear in the line, and
# no classes on which regular-expression engines differ.
END_MARK = r"[.!?;:…。！？\"'”’»)\]]\z"  # a sentence mark, closing quote or bracket at the end
SEPARATOR = r"[\x20\x09][|>»•·/][\x20\x09]"  # between the items of a menu
DECORATION = r"!!|[#*$%&<>][#*$%&<>]"
BOILERPLATE = (r"(?i)all rights reserved|copyright \(c\)|licensed under|released under the|"
               r"under the terms of|terms of use|terms of service|privacy policy|cookie policy|"
               r"we use cookies|enable javascript|subscribe to our|lorem ipsum")
BOILERPLATE_WORDS = 30  # a longer line that holds such a phrase is prose about it


def line_passes(line: Column, max_symbol_share: float = 0.1) -> Column:
    """Whether a line with a word is kept by the line rules."""
    def count(pattern: str) -> Column:
        return F.regexp_count(line, F.lit(pattern))

    n_words = count(WORD_PATTERN)
    chars = F.length(line) - count(SPACE_CLASS)
    # a long line without an end mark is prose that was cut; a short one is a
    # title, a button or a list item
    punctuated = (n_words >= 5) | F.btrim(line, F.lit(SPACES)).rlike(END_MARK)
    navigation = (count(SEPARATOR) >= 3) & (count(SEPARATOR) * 10 > n_words)
    decorated = (count(DECORATION) >= 3) & (count(DECORATION) * 4 > n_words)
    boilerplate = (n_words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return (punctuated & ~navigation & ~decorated & ~boilerplate
            & (count(SYMBOL_CLASS) <= chars * F.lit(max_symbol_share)))


def repeated_window_words(word_array: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more.

    Window hashes are sorted next to each other with their positions, so the
    work is n log n in the text's words.
    """
    def of_hashes(h: Column) -> Column:
        # hashes of words i, i+1, i+2; the last two positions have no window
        windows = F.sort_array(F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("w"), i.alias("i"))))
        return let(windows, positions)

    def positions(s: Column) -> Column:
        repeated = F.filter(s, lambda e, i: (
            F.coalesce(F.get(s, i - 1)["w"] == e["w"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["w"] == e["w"], F.lit(False))))
        covered = F.flatten(F.transform(repeated, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))
        return F.size(F.array_distinct(covered)).cast("long")

    return let(F.transform(word_array, lambda w: F.xxhash64(w)), of_hashes)


def judge_quality(docs: DataFrame, text_col: str = "text", min_words: int = 50, max_repeat_percent: int = 50,
                  max_lost_share: float = 0.5, result: str = "quality") -> DataFrame:
    """``docs`` with one more column ``result``, a struct of ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept`` and ``clean_text``."""
    if result in docs.columns:
        raise ValueError(f"the table has a column {result} already")
    text = text_or_empty(text_col)
    has_word = lambda line: line.rlike(WORD_PATTERN)
    chars = lambda c: F.length(c) - F.regexp_count(c, F.lit(SPACE_CLASS))
    parts = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text.alias("text"),
                        words(text).alias("words"), F.split(text, "\n").alias("lines"))
    parts = parts.select(
        "*", F.filter("lines", has_word).alias("full"),
        F.filter("lines", lambda x: ~has_word(x) | line_passes(x)).alias("passed"))
    measured = parts.select(
        "row", F.array_join("passed", "\n").alias("clean_text"), F.size("words").cast("long").alias("n_words"),
        chars(F.col("text")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL_CLASS)).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"))
    base_failed = ((F.col("n_words") < min_words)
                   | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    lost = F.col("word_chars") - chars(F.col("clean_text"))
    kept = ~base_failed & (lost <= F.col("word_chars") * F.lit(max_lost_share))
    return measured.select("row.*", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), kept.alias("kept"), "clean_text").alias(result))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: ``id_col`` and the fields of ``judge_quality``
    (``clean_text`` is the text without its failed lines).

    Null text is a text without words; it and any blank text fail the base
    rule. Lines without a word stay and count for nothing. Rows are judged one
    by one, so repeated rows get equal results and null ids do no harm.
    """
    bare = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return judge_quality(bare, "text", **limits).select(F.col("id").alias(id_col), "quality.*")
