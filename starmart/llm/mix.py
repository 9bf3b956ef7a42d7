"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import text_or_empty, word_count
from starmart.session import materialize


def water_fill(sources: DataFrame, total_share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``.

    The sizes' sum times ``total_share`` is dealt by weight. Sources whose part
    exceeds ``max_epochs`` times their size are clamped there and the excess is
    dealt again over the others, until none is above. A round brings two sums
    to the driver; every round but the last clamps a source.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    budget = float(sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    level, clamped = 0.0, -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        r = sources.agg(
            F.sum(F.when(above, cap)).alias("fixed"), F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if r["n"] == clamped or not r["open"]:
            break
        clamped = r["n"]
        level = max(0.0, budget - (r["fixed"] or 0.0)) / float(r["open"])
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5,
                max_epochs: float = 2.0, seed: int = 0, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", run_rows: int = 2048, keep_source: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``size`` (words), ``source_size``,
    ``target`` (of its source), ``repeats`` (times the mix takes the row) and
    ``taken`` (``repeats * size``); with ``keep_source`` also ``source_col``.

    Sources in code-point order, null last, take ``weights`` in turn. A source
    of size s and target t takes every row floor(t / s) times and, in an order
    seeded per row, the first rows once more until the rest of t is filled to
    within half a row. Null text has size 0; a source without words takes
    nothing beyond its whole repeats; rows alike in id and size may be taken
    unequally by the one at the border; an empty table gives an empty result.
    """
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        # a null source is a source too, so it gets a key that joins
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("null")).alias("skey"),
        word_count(text_or_empty(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
              .cast("binary")).alias("draw")), "mix-sizes")
    n_weights = len(weights)
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    sources = materialize(
        rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place % n_weights)),
        "mix-sources")
    targets = (water_fill(sources, total_share, max_epochs)
               .withColumn("whole", F.when(F.col("source_size") > 0,
                                           F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))))
                           .otherwise(F.lit(0)).cast("long"))
               .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
               .select("skey", "source_size", "target", "whole", "part"))

    # Running sums in seeded order without sorting a source in one task: the
    # draw's leading digits cut a source into runs; sums of earlier runs come
    # from the small table of runs.
    digits, n_rows = 0, rows.count()
    while 16 ** digits * run_rows < n_rows:
        digits += 1
    rows = rows.withColumn("run", F.substring("draw", 1, digits) if digits else F.lit(""))
    earlier = W.partitionBy("skey").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = (rows.groupBy("skey", "run").agg(F.sum("size").alias("n"))
            .select("skey", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_run"))
            .join(targets, "skey"))
    within = (W.partitionBy("skey", "run").orderBy("draw", F.col("id").asc_nulls_last(), "size")
              .rowsBetween(W.unboundedPreceding, -1))
    return (rows.join(runs, ["skey", "run"])
            .withColumn("before", F.col("before_run") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .withColumn("repeats", F.col("whole") + F.when(
                (F.col("part") > 0) & (F.col("before") + F.col("size") * 0.5 <= F.col("part")), 1).otherwise(0))
            .select(F.col("id").alias(id_col), *([F.col("source").alias(source_col)] if keep_source else []),
                    "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken")))
