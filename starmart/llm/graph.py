"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.session import materialize

SMALL = 16 << 20  # bytes up to which a written table is broadcast rather than shuffled


def compact(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for a table far smaller than what it is made from: a few
    tasks a core write it, not one for every shuffle partition."""
    return materialize(df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism), name)


def small(df: DataFrame) -> DataFrame:
    """A written table as a join's side: broadcast if it is small."""
    return checked_broadcast(df, max_bytes=SMALL)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is one node of the
    component. Each round every node follows its least neighbour in a seeded
    random order and the links are contracted, so the number of rounds grows
    with the logarithm of a component's size. Only counts reach the driver;
    nulls are not links."""
    links = compact(links.select("a", "b").where("a <> b").distinct(), "links")
    roots: DataFrame | None = None
    round_ = 0
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(round_)).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        step = compact(
            both.groupBy("a").agg(F.min(rank("b")).alias("low"))
            .select(F.col("a").alias("node"), F.least("low", F.struct(
                F.xxhash64("a", F.lit(round_)).alias("h"), F.col("a").alias("node")))["node"].alias("root")),
            "component-step")
        side = small(step)
        to = lambda c, new: side.select(F.col("node").alias(c), F.col("root").alias(new))  # noqa: B023, E731
        links = compact(
            links.join(to("a", "a2"), "a").join(to("b", "b2"), "b")
            .where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            "links")
        if roots is None:
            roots = step
        else:
            roots = compact(
                roots.join(to("root", "next"), "root", "left")
                .select("node", F.coalesce("next", "root").alias("root")), "component-roots")
        round_ += 1
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
