"""Shard assignment by a hierarchical weighted hash tree. DataFrame functions only.

A row descends region, rack and shard levels. At each level every child draws
``-ln(u) / weight`` with ``u`` a hash of the row's key and the child's own
name, and the smallest draw wins (weighted rendezvous hashing). A child's draw
depends on nothing but the key, its name and its weight: when weights below
one child change, a row moves only into or out of that subtree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import text_or_empty
from starmart.session import materialize


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree: number, region, rack and weight."""
    number: int
    region: int
    rack: int
    weight: float = 1.0


def shard_tree(n_shards: int, regions: int = 2, racks: int = 3, built: int = 24) -> list[Shard]:
    """The tree of ``n_shards`` equal shards: up to ``built`` of them, the first
    build-out, are dealt over ``regions`` x ``racks``; every further one was added
    by ``grow``. So ``shard_tree(n + 1) == grow(shard_tree(n))`` from ``built`` on,
    and one more shard takes rows only into itself. Below, another count is
    another build-out, from which a table has to be moved as a whole."""
    n, cells = min(n_shards, built), regions * racks
    tree = [Shard(i, i * regions // n, (i * cells // n) % racks) for i in range(n)]
    for _ in range(n_shards - n):
        tree = grow(tree)
    return tree


def grow(tree: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own: no weight of an
    existing subtree changes, so rows move into the new shard and nowhere else."""
    number = max((s.number for s in tree), default=-1) + 1
    region = max((s.region for s in tree), default=-1) + 1
    return [*tree, Shard(number, region, 0, weight)]


def _draw(key: Column, node: tuple, weight: float, seed: int) -> Column:
    h = F.xxhash64(key, F.lit(f"{seed}/" + ".".join(map(str, node))))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(float(weight))


def _weights(tree: Sequence[Shard]) -> list[dict[tuple, dict[int, float]]]:
    """Per level: node path -> child number -> weight of the child's subtree."""
    levels: list[dict[tuple, dict[int, float]]] = [{}, {}, {}]
    for s in tree:
        if s.weight > 0:
            path = (s.region, s.rack, s.number)
            for level in range(3):
                node = levels[level].setdefault(path[:level], {})
                node[path[level]] = node.get(path[level], 0.0) + s.weight
    return levels


def _descend(df: DataFrame, key: str, tree: Sequence[Shard], seed: int, out: str) -> DataFrame:
    """``df`` with the shard number of ``key`` in ``out``."""
    steps = [f"{out}_region", f"{out}_rack", out]
    for level, nodes in enumerate(_weights(tree)):
        chosen = None
        for path, kids in nodes.items():
            draws = [F.struct(_draw(F.col(key), path + (kid,), w, seed), F.lit(kid).alias("child"))
                     for kid, w in kids.items()]
            best = (F.array_min(F.array(*draws))["child"] if len(draws) > 1
                    else F.lit(next(iter(kids))))
            here = F.lit(True)
            for step, node in zip(steps, path):
                here = here & (F.col(step) == node)
            chosen = best if level == 0 else (chosen.when(here, best) if chosen is not None
                                              else F.when(here, best))
        df = df.withColumn(steps[level], chosen)
    return df


def assign_shards(docs: DataFrame, tree: Sequence[Shard] | int = 24, id_col: str = "doc_id",
                  text_col: str = "text", seed: int = 0, run_rows: int = 4096) -> DataFrame:
    """One row per input row: ``id_col``, ``size`` (UTF-8 bytes + 8),
    ``text_crc32``, ``law`` ('key'), ``shard``, ``slot``, ``grown_shard``.

    The id and the tree alone decide the shard; equal ids share one. A null id
    is a key of its own, a null text has no bytes. ``slot`` numbers a shard's
    rows from 0 without gaps, in order of a hash of id and text, so no shard is
    sorted in one task: rows are numbered within runs of about ``run_rows`` and
    shifted by the rows of earlier runs. Rows alike in id and text take
    adjacent slots. ``grown_shard`` is the shard under ``grow(tree)``.
    """
    if isinstance(tree, int):
        tree = shard_tree(tree)
    if not any(s.weight > 0 for s in tree):
        raise ValueError("the tree needs a shard of positive weight")
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("null")).alias("key"))
    rows = _descend(rows, "key", tree, seed, "shard")
    rows = _descend(rows, "key", grow(tree), seed, "grown_shard")
    rows = materialize(rows.select("id", "size", "text_crc32", "shard", "grown_shard",
                                   F.xxhash64("key", "text_crc32", "size").alias("h")), "shards")
    runs, n_rows = 1, rows.count()
    while runs * run_rows * len(tree) < n_rows:
        runs *= 2
    # the hash's leading bits name the run, so runs follow the hash's order
    shift = 64 - runs.bit_length() + 1
    run = F.shiftright("h", shift) if runs > 1 else F.lit(0).cast("long")
    rows = rows.withColumn("run", run)
    before = W.partitionBy("shard").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    within = W.partitionBy("shard", "run").orderBy("h", F.col("id").asc_nulls_last(), "text_crc32", "size")
    return (rows.join(offsets, ["shard", "run"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.row_number().over(within) - 1).cast("long").alias("slot"),
                    "grown_shard"))
