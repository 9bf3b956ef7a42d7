"""Filter interaction audit with min-plus removal ranks.

What a chain of filters removes at which step depends on their order. A
document only matters by its mask (which filters it fails), so Spark counts
documents by part and mask; numpy then combines the matrix of masks (0 where a
filter fails, else infinity) with the matrix of every order's inverse
permutation (the filters' steps) by sum and minimum. The result is the step at
which a mask falls in an order; the counts are scattered to those steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import let, text_or_empty, words
from starmart.operators.joins import checked_broadcast
from starmart.session import materialize

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


# numpy

def removal_steps(masks: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """(orders, masks): the step that removes a mask, infinity where none does.

    ``masks`` (masks, filters) tells what fails, ``steps`` (orders, filters)
    the step of each filter: the min-plus product of the two."""
    free = np.where(masks, 0.0, np.inf)
    return (steps[:, None, :] + free[None, :, :]).min(axis=2)


class Orders:
    """All orders of some filters and what each step does to each mask."""

    def __init__(self, letters: str):
        n = len(letters)
        orders = np.array(list(permutations(range(n))))  # filter at each step
        steps = np.argsort(orders, axis=1) + 1  # inverse permutations: step of each filter
        self.names = ["".join(letters[f] for f in order) for order in orders]
        self.n_filters, self.n_masks, self.orders = n, 1 << n, orders
        masks = (np.arange(self.n_masks)[:, None] >> np.arange(n)) & 1 == 1
        falls = removal_steps(masks, steps)
        step = np.arange(1, n + 1)
        fails = masks.T[orders]  # (orders, steps, masks)
        self.falls = np.where(np.isinf(falls), 0, falls).astype(np.int64)
        self.redundant = (fails & (falls[:, None, :] < step[None, :, None])).astype(np.int64)

    def scattered(self, weights: np.ndarray) -> np.ndarray:
        """(orders, steps): sums of the masks' weights at the steps where they fall."""
        n_orders, width = len(self.orders), self.n_filters + 1
        at = self.falls + np.arange(n_orders)[:, None] * width
        out = np.zeros(n_orders * width, np.int64)
        np.add.at(out, at.ravel(), np.broadcast_to(weights, at.shape).ravel())
        return out.reshape(n_orders, width)[:, 1:]  # step 0: never removed

    def counts(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
        """The count columns of ``SCHEMA``, one entry per order and step."""
        removed = self.scattered(n)
        kept = n.sum() - np.cumsum(removed, axis=1)
        alone = n[1 << self.orders]
        by_filter = np.zeros(self.n_filters, np.int64)
        np.add.at(by_filter, self.orders.ravel(), removed.ravel())
        return [x.ravel() for x in (kept, removed, self.redundant @ n, alone, self.scattered(good),
                                    self.scattered(toxic), by_filter[self.orders])]


def audit_masks(counted: DataFrame, letters: str) -> DataFrame:
    """All orders of the filters ``letters`` (bit k of a mask: the k-th fails),
    per ``part`` of ``counted`` (part, mask, n, good, toxic). At most eight
    filters. A part has at most one row per mask, so it is held whole."""
    if not 0 < len(letters) <= 8 or len(set(letters)) < len(letters):
        raise ValueError("one to eight different filters")

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(letters)
        n_rows = len(orders.names) * orders.n_filters
        names = pa.array(np.repeat(orders.names, orders.n_filters))
        steps = pa.array(np.tile(np.arange(1, orders.n_filters + 1), len(orders.names)), pa.int32())
        for batch in batches:
            for row in batch.to_pylist():
                sums = np.zeros((3, orders.n_masks), np.int64)
                for m in row["masks"]:
                    sums[:, m["mask"]] += (m["n"], m["good"], m["toxic"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n_rows, pa.string()), names, steps,
                     *[pa.array(x, pa.int64()) for x in orders.counts(*sums)]],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    per_part = counted.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).groupBy(
        "part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return per_part.mapInArrow(audit, SCHEMA)


# filters

def text_filters(text: Column) -> list[Column]:
    """What fails of A to D: few words, few distinct ones, many capitals, odd signs."""
    def over_words(w: Column) -> Column:
        return F.struct((F.size(w) < 100).alias("short"),
                        (F.size(F.array_distinct(w)).cast("long") * 100 < F.size(w).cast("long") * 80).alias("repeats"))

    judged = let(words(text), over_words)
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 10
    return [judged["short"], judged["repeats"], capitals, text.rlike(r"[#$%&*|]")]


def masked_documents(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, sha, mask): the mask of the filters on the text alone."""
    text = F.col("text")
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(text_filters(text))]
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text_or_empty(text_col).alias("text"))
            .select("id", "part", F.unhex(F.sha2(text, 256)).alias("sha"), sum(bits[1:], bits[0]).alias("mask")))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """The audit of filters A to E per value of ``part_col`` (null: empty string),
    one row per part, ``filter_order`` and ``step``, with the counts of ``SCHEMA``.

    E fails where a smaller id's text in the whole table is identical. Null text
    is empty. Rows that share an id are documents of their own and do not fail E
    by each other; a null id is neither smaller nor larger than another. A
    document is good (toxic) if any label row of its id says 1; null ids have no
    labels. An empty table gives an empty result.
    """
    flags = (labels.select(F.col(id_col).alias("label_id"), F.col(good_col).alias("g"), F.col(toxic_col).alias("t"))
             .where("label_id IS NOT NULL").groupBy("label_id")
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("g", "t")]))
    # Counted before every shuffle, so neither a text nor an id that many rows
    # share brings them all to one task.
    by_id = masked_documents(docs, id_col, text_col, part_col).groupBy("id", "part", "sha", "mask").agg(
        F.count("*").alias("n"))
    flagged = by_id.join(flags, by_id["id"] == flags["label_id"], "left").select(
        "id", "part", "sha", "mask", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("g", "t")])
    by_text = materialize(
        flagged.groupBy("sha", "part", "mask", "g", "t")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
             F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")), "audit-texts")
    # only texts that occur again need their first id, which may stand in several
    # parts or have several rows
    repeated = checked_broadcast(materialize(
        by_text.groupBy("sha").agg(F.sum("n").alias("copies"), F.min("least.id").alias("first"))
        .where("copies > 1").select(F.col("sha").alias("copy_sha"), "first"), "audit-copies"))
    alone = F.sum(F.when(F.col("copy_sha").isNull(), F.col("n")).otherwise(
        F.col("no_id") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)))
    counted = (by_text.join(repeated, by_text["sha"] == F.col("copy_sha"), "left").groupBy("part", "mask", "g", "t")
               .agg(F.sum("n").cast("long").alias("n"), alone.cast("long").alias("passed")))
    both = counted.select("part", "g", "t", F.explode(F.array(
        F.struct("mask", F.col("passed").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passed")).alias("n")))).alias("m"))
    return audit_masks(both.select("part", "m.mask", "m.n", (F.col("g") * F.col("m.n")).alias("good"),
                                   (F.col("t") * F.col("m.n")).alias("toxic")), "ABCDE")
