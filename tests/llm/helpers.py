"""Small tables and plain-Python twins for the tests of the operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

# names the operators use inside or return
CLASHING = ["id", "row", "sha", "key", "size", "kept", "shard", "slot", "run", "node", "root", "bucket", "words",
            "lines", "quality", "keys", "pieces", "doc_key", "score", "target", "weight", "draw", "skey", "repeats",
            "n_words", "name", "first_id", "gone_id", "text_a", "keep_id", "class_id", "group_size", "block"]


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeats."""
    rng = random.Random(5)
    passage = " ".join(prose(rng, 80))
    base = prose(rng, 120)
    near = list(base)
    near[60] = "changed"
    long_text = "\n".join(" ".join(prose(rng, 40, 20000)) + "." for _ in range(600))
    rows = [
        (None, None, None, None, None),
        (None, "a text without an id.", "en", "s1", 21),
        (1, None, "en", "s1", None),
        (2, "", "en", "s2", 0),
        (3, " \t\r\n\x0b\x0c ", None, None, 7),
        (4, "one", "en", "s1", 3),
        (5, " one ", "en", "s1", 5),
        (6, "one", "en", None, 3),
        (7, " ".join(base), "en", "", 1),
        (8, " ".join(near), "en", "é", 1),
        (8, " ".join(near), "en", "é", 1),
        (9, " ".join(base), "en", "s1", 1),
        (10, " ".join(prose(rng, 60)) + "\n" + passage + "\n" + " ".join(prose(rng, 70)), "en", "s2", 1),
        (11, " ".join(prose(rng, 90)) + "\n" + passage, "en", "s3", 1),
        (12, long_text, "en", "s3", 1),
        (13, long_text + "\nEND", "en", "s3", 1),
        (14, "x" * 30000, "en", "s3", 1),
        (15, "la la la " * 200, "en", "s4", 1),
        (16, "日本語のテキスト ▁ é́ 😀 <|endoftext|> \x00\x01 nbsp here there\x85end", "ja", "s4", 1),
        (17, "A | B | C | D | E\nAll rights reserved.\n" + " ".join(prose(rng, 60)) + ".", "en", "s4", 1),
        (18, "A shared line of text\nAnother, only here\n  a SHARED line of text \r\nA shared line of text", "en", "s1", 1),
        (19, "a shared line of text\nÀ shared line of text\nshort", "en", "s1", 1),
        (20, "a shared line of text\nshort\nÀ shared line of text", "en", "s1", 1),
    ]
    return rows


def odd_table(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def words(text):
    return WORD.findall(text or "")


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls last, so that repeated rows count."""
    columns = columns or sorted(df.columns)
    found = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))
