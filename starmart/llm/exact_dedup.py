"""Exact dedup by two passes over a Bloom filter. DataFrame functions only.

Pass 1 hashes every normalised text and counts, per bit of a blocked Bloom
filter, how many rows hit it; only bits hit twice or more are set. Pass 2 tests
each row: a text that occurs twice has hit all its bits twice, so a row with
an unset bit is certainly single and passes straight through. Only the rows
that may be repeated shuffle on their SHA-256, as (id, length, hash): texts
never move. A false positive merely shuffles one more small row; the result is
exact whatever the filter's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import text_or_empty, without_spaces
from starmart.session import materialize

BLOCK_BITS = 32768  # bits that bitmap_construct_agg holds in one binary value


def _filter_blocks(n_rows: int, bits_per_row: int, max_bits: int) -> int:
    return max(1, min(bits_per_row * n_rows, max_bits) // BLOCK_BITS)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = 16, max_bits: int = 1 << 30) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size`` (long),
    ``kept`` (boolean), ``text_sha256`` (of the text without white space).

    Of equal texts the one with the most code points stays, then the smallest
    id; a null id loses against any other. Null text counts as empty, and all
    empty texts are equal. Rows that repeat the survivor's id and length are
    the survivor again and are all kept. An empty table gives an empty result.
    The broadcast filter is at most ``max_bits`` / 8 bytes; past
    ``max_bits / bits_per_row`` rows more singles shuffle, nothing else changes.
    """
    text = text_or_empty(text_col)
    rows = materialize(docs.select(
        F.col(id_col).alias("id"),
        F.sha2(without_spaces(text), 256).alias("sha"),
        F.length(text).cast("long").alias("len")), "exact-hashes")
    n_blocks = _filter_blocks(rows.count(), bits_per_row, max_bits)

    h = F.xxhash64("sha")
    hashed = rows.select(
        "*", F.pmod(h, F.lit(n_blocks)).alias("block"),
        F.pmod(F.xxhash64("sha", F.lit(1)), F.lit(BLOCK_BITS)).alias("b1"),
        F.pmod(F.xxhash64("sha", F.lit(2)), F.lit(BLOCK_BITS)).alias("b2"))
    # pass 1: bits hit at least twice. The two bits of one row may be the same
    # one; array_distinct keeps such a row from counting as two.
    bits = hashed.select("block", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("bit"))
    twice = (bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    filter_ = twice.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def bit_set(bit: str):
        byte = F.substring(F.col("bitmap"), (F.floor(F.col(bit) / 8) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.get(F.array(*[value.bitwiseAND(1 << i) for i in range(8)]),
                     (F.col(bit) % 8).cast("int")) != 0

    # pass 2: the filter has a proven bound, so it may be broadcast
    tested = materialize(hashed.join(F.broadcast(filter_), "block", "left").select(
        "id", "sha", "len",
        F.coalesce(bit_set("b1") & bit_set("b2"), F.lit(False)).alias("maybe")), "exact-tested")
    single = tested.where(~F.col("maybe")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    maybe = tested.where("maybe")
    # one small row per repeated text, combined map-side; written, so that the
    # join below is between two plain shuffles and AQE can split a hot text
    groups = materialize(
        maybe.groupBy("sha").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct((-F.col("len")).alias("neg_len"), F.col("id").isNull().alias("no_id"),
                           F.col("id").alias("id"))).alias("best")), "exact-groups")
    resolved = maybe.join(groups, "sha").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("len") == -F.col("best.neg_len"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return single.unionByName(resolved)
