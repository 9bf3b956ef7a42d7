"""N-gram Jaccard join by MinHash banding, pairs verified on full n-gram sets.

Copies (equal n-gram sets) are one node. A node's bands shuffle by band hash;
nodes that share a bucket are candidates. A bucket is not expanded into pairs:
a hub is compared with its other members, links found contract nodes into
components, and hubs are taken from a bucket until what is left of it lies in
one component. A member thus drops out only after it has been compared with,
or is already connected to, everything it shared the bucket with: no link
that banding brings up is lost, and a group of near copies costs one
comparison per member. Members that the first hub leaves apart are compared
with each other only where the n-grams they share with it, and those outside
it that others have too, allow them to be similar. These links make the classes;
how many links a node has is then counted over all pairs of its class, block by
block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import text_or_empty
from starmart.llm.graph import compact, components, small
from starmart.llm.hashing import mix, ngram_hashes, word_hashes
from starmart.session import materialize


def choose_bands(similarity: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band such that a pair of exactly
    ``similarity`` shares a bucket with probability ``recall`` at least."""
    for rows in range(max_hashes, 0, -1):
        collide = similarity ** rows
        bands = 1 if collide >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-collide))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("max_hashes is too small for this recall")


def ngram_set(text: str, n: int) -> np.ndarray:
    return np.unique(ngram_hashes(word_hashes(text), n))


def set_name(grams: np.ndarray) -> bytes | None:
    """16 bytes naming an n-gram set; None for the empty one."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int, block: int = 8192) -> np.ndarray:
    """One hash per band of the set's MinHash values."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), block):
        for j in range(0, len(low), 32):  # a slice of the products that stays in cache
            part = grams[i:i + block, None] * odd[j:j + 32] + add[j:j + 32]
            low[j:j + 32] = np.minimum(low[j:j + 32], part.min(axis=0))
    out = np.arange(bands, dtype=np.uint64)
    for row in low.reshape(bands, rows).T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
    return out


def _signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("node", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node, out = [], []
            for text in batch["text"]:
                grams = ngram_set(text, n)
                node.append(set_name(grams))
                out.append(band_hashes(grams, bands, rows, seed).view(np.int64) if len(grams) else None)
            yield pd.DataFrame({"id": batch["id"].array, "node": node, "bands": out})

    return docs.mapInPandas(sign, schema)


def _node_texts(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, text) with one text for each of ``nodes`` (id, node)."""
    wanted = nodes.select(F.col("id").alias("node_id"), "node")
    wanted = small(wanted)
    rows = docs.join(wanted, F.col("id").eqNullSafe(F.col("node_id"))).select("node", "text")

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # of rows that share an id only those with the node's n-grams
            yield batch[[set_name(ngram_set(t, n)) == bytes(k) for t, k in zip(batch["text"], batch["node"])]]

    return rows.mapInPandas(own, "node binary, text string").groupBy("node").agg(F.min("text").alias("text"))


def _compared(pairs: DataFrame, texts: DataFrame, n: int, outside: bool) -> DataFrame:
    """Pairs (a, b) with their full n-gram sets' sizes and ``common`` n-grams;
    with ``outside`` also a's n-grams that b does not have."""
    def side(c: str) -> DataFrame:
        return texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes_a, sizes_b, common, rest = [], [], [], []
            last, of_last = None, None
            for x, y in zip(batch["text_a"], batch["text_b"]):
                if y != last:  # hubs come in runs
                    last, of_last = y, ngram_set(y, n)
                grams = ngram_set(x, n)
                sizes_a.append(len(grams))
                sizes_b.append(len(of_last))
                left = np.setdiff1d(grams, of_last, assume_unique=True)
                common.append(len(grams) - len(left))
                rest.append(left.view(np.int64) if outside else None)
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "size_a": sizes_a, "size_b": sizes_b,
                                "common": common, "outside": rest})

    return (small(pairs).join(side("a"), "a").join(side("b"), "b").mapInPandas(
        compare, "a binary, b binary, size_a long, size_b long, common long, outside array<long>"))


def _links_of(compared: DataFrame, similarity: float) -> DataFrame:
    # sizes are integers, so a pair at the threshold is off by rounding at most
    jaccard = F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))
    return (compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), jaccard.alias("jaccard"))
            .where(F.col("jaccard") >= F.lit(similarity - 1e-12)))


def _bounded(members: DataFrame, compared: DataFrame, similarity: float) -> DataFrame:
    """Members (bucket, node, first_hub) of open buckets with what bounds the
    overlap of two of them: ``size``, ``common`` with their bucket's first hub,
    and ``own``, n-grams outside the hub that no other member compared with
    that hub has. Members that can have no similar partner are left out: of
    their n-grams more are their own than the similarity allows."""
    asked = members.select(F.col("node").alias("a"), F.col("first_hub").alias("b")).distinct()
    open_ = compact(compared.join(asked, ["a", "b"], "left_semi"), "ngram-open-pairs")
    grams = open_.select(F.xxhash64("b").alias("hub"), F.xxhash64("a").alias("node"), F.explode("outside").alias("gram"))
    own = (grams.groupBy("hub", "gram").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
           .where("n = 1").groupBy("hub", "node").agg(F.count(F.lit(1)).alias("own")))
    facts = compact(
        open_.select("a", "b", "size_a", "common", F.xxhash64("b").alias("hub"), F.xxhash64("a").alias("node"))
        .join(own, ["hub", "node"], "left")
        .select(F.col("a").alias("node"), F.col("b").alias("first_hub"), F.col("size_a").alias("size"), "common",
                F.coalesce("own", F.lit(0)).alias("own"))
        .where(F.col("size") - F.col("own") >= F.col("size") * F.lit(similarity - 1e-9)), "ngram-bounds")
    return members.join(small(facts), ["node", "first_hub"])


def _may_be_similar(similarity: float):
    """Whether the bounds of two members of a bucket allow ``similarity``: what
    they share inside the first hub is at most what either shares with it, and
    what they share outside is at most what either has there that is not its own."""
    outside = lambda c: F.greatest(F.col(f"{c}size") - F.col(f"{c}common") - F.col(f"{c}own"), F.lit(0))
    most = F.least(F.col("common"), F.col("h_common")) + F.least(outside(""), outside("h_"))
    return most >= F.lit(similarity / (1 + similarity) - 1e-9) * (F.col("size") + F.col("h_size"))


def _first_shared() -> F.Column:
    """Whether a bucket is the first that a member and a hub share. Of all buckets
    in which two nodes meet, this one alone pairs them. Until it has, it holds them
    both, or one of them was its first hub and has met the other."""
    equal = F.zip_with("bands", "h_bands", lambda x, y: x == y)
    return F.get(F.col("bands"), (F.array_position(equal, F.lit(True)) - 1).cast("int")) == F.col("bucket")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``roots`` (node, root) after more links between nodes."""
    side = small(roots)

    def root_of(c: str) -> DataFrame:
        return side.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))

    ends = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = components(ends)
    to = small(joined).select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = joined.join(small(roots.select("node")), "node", "left_anti")
    return compact(moved.unionByName(new), "ngram-roots")


def _degrees(roots: DataFrame, texts: DataFrame, n: int, similarity: float, block_nodes: int = 512,
             block_bytes: int = 4 << 20) -> DataFrame:
    """(node, n_links): the nodes of its component similar to each linked node.
    Each block of a component's nodes meets each other one in one group of rows,
    so no pair becomes a row."""
    both = texts.join(small(roots), "node").select("root", "node", "text", F.octet_length("text").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("nodes") / block_nodes, F.col("bytes") / block_bytes))
    sizes = compact(both.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), F.sum("bytes").alias("bytes"))
                    .select("root", blocks.alias("blocks")), "ngram-blocks")
    placed = (both.drop("bytes").join(small(sizes), "root")
              .withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                      "own", "node", "text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, []
        for batch in batches:
            out = []
            for root, low, high, own, node, text in zip(*(batch[c] for c in ("root", "low", "high", "own", "node", "text"))):
                if (root, low, high) != last:
                    out += similar_counts(held, last, similarity)
                    last, held = (root, low, high), []
                held.append((own, node, ngram_set(text, n)))
            yield pd.DataFrame(out, columns=["node", "n_links"])
        yield pd.DataFrame(similar_counts(held, last, similarity), columns=["node", "n_links"])

    return (placed.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
            .mapInPandas(count, "node binary, n_links long").groupBy("node").agg(F.sum("n_links").alias("n_links")))


def similar_counts(rows: list[tuple], blocks: tuple | None, similarity: float,
                   width: int = 4096) -> list[tuple[bytes, int]]:
    """(node, similar ones) of the rows (block, node, n-gram set) of two blocks,
    ``blocks`` being (root, one, other): pairs across them, or within one."""
    if not rows:
        return []
    within = blocks[1] == blocks[2]
    a = [r for r in rows if r[0] == blocks[1]]
    b = a if within else [r for r in rows if r[0] == blocks[2]]
    if not a or not b:
        return []

    def flat(side: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(r[2]) for r in side])
        return np.concatenate([r[2] for r in side]), np.repeat(np.arange(len(side)), size), size

    grams_a, of_a, size_a = flat(a)
    grams_b, of_b, size_b = flat(b)
    both = np.intersect1d(grams_a, grams_b)
    column_a, column_b = np.searchsorted(both, grams_a), np.searchsorted(both, grams_b)
    keep_a = both[np.minimum(column_a, len(both) - 1)] == grams_a if len(both) else np.zeros(len(grams_a), bool)
    keep_b = both[np.minimum(column_b, len(both) - 1)] == grams_b if len(both) else np.zeros(len(grams_b), bool)
    column_a, of_a, column_b, of_b = column_a[keep_a], of_a[keep_a], column_b[keep_b], of_b[keep_b]
    common = np.zeros((len(a), len(b)))
    by_a, by_b = np.argsort(column_a, kind="stable"), np.argsort(column_b, kind="stable")
    column_a, of_a, column_b, of_b = column_a[by_a], of_a[by_a], column_b[by_b], of_b[by_b]
    for start in range(0, len(both), width):  # n-grams as columns, a slice at a time
        parts = []
        for column, of, m in ((column_a, of_a, len(a)), (column_b, of_b, len(b))):
            low, high = np.searchsorted(column, (start, start + width))
            part = np.zeros((m, min(width, len(both) - start)), np.float32)
            part[of[low:high], column[low:high] - start] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T  # exact: a slice's counts are small integers
    similar = common / (size_a[:, None] + size_b[None, :] - common) >= similarity - 1e-12
    if within:
        np.fill_diagonal(similar, False)
        return [(r[1], int(c)) for r, c in zip(a, similar.sum(axis=1))]
    return [(r[1], int(c)) for r, c in (*zip(a, similar.sum(axis=1)), *zip(b, similar.sum(axis=0)))]


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                similarity: float = 0.8, recall: float = 0.9999, max_hashes: int = 128, seed: int = 0,
                first_hubs: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, roots): rows with their node (id, node), the verified
    links between nodes (a, b, jaccard) that connect the classes, and the
    component of every linked node (node, root). Rows without words have no node."""
    return _connected(docs, id_col, text_col, n, similarity, recall, max_hashes, seed, first_hubs)[:3]


def _connected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
               similarity: float = 0.8, recall: float = 0.9999, max_hashes: int = 128, seed: int = 0,
               first_hubs: int = 64) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``ngram_links``, and (node, text) of the nodes that share a bucket."""
    bands, rows = choose_bands(similarity, recall, max_hashes)
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    signed = materialize(_signatures(source, n, bands, rows, seed), "ngram-signatures")
    nodes = (signed.where("node IS NOT NULL").groupBy("node")
             .agg(F.any_value("bands").alias("bands"),
                  F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id")))["id"].alias("id")))
    entries = materialize(nodes.select("node", F.explode("bands").alias("bucket")), "ngram-entries")
    # counted map-side; written, so that a hot bucket can be split in the join
    shared = compact(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "ngram-buckets")
    members = compact(entries.join(small(shared), "bucket"), "ngram-members")
    involved = members.select("node").distinct()
    first_ids = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id")))["id"].alias("id"))
    texts = materialize(_node_texts(source, compact(first_ids.join(involved, "node", "left_semi"), "ngram-involved"), n), "ngram-texts")

    spark = docs.sparkSession
    # Round 0: every member of a bucket against the one that shares most with
    # others, which in a group of copies is the original or next to it.
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    first = compact(
        members.join(weights, "node").groupBy("bucket")
        .agg(F.max_by("node", F.struct("weight", F.xxhash64("node"))).alias("first_hub")), "ngram-hubs")
    members = compact(members.select("node", "bucket").join(small(first), "bucket").where("node <> first_hub"),
                          "ngram-members")
    pairs = compact(members.select(F.col("node").alias("a"), F.col("first_hub").alias("b")).distinct(), "ngram-pairs")
    compared = materialize(_compared(pairs, texts, n, outside=True), "ngram-compared")
    links = compact(_links_of(compared, similarity), "ngram-links")
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    roots = _merged(spark.createDataFrame([], "node binary, root binary"), links)

    # Rounds: what is left of buckets whose members lie in several components
    n_hubs, bounded = first_hubs, False
    while True:
        sized = compact(roots.join(small(compact(
            roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "ngram-sizes")), "root"), "ngram-sized")
        placed = (members.join(small(sized), "node", "left")
                  .withColumns({"root": F.coalesce("root", "node"), "n": F.coalesce("n", F.lit(1))}))
        open_ = compact(
            placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                         F.max(F.struct("n", "root"))["root"].alias("main"))
            .where("low <> high").select("bucket", "main"), "ngram-open")
        if open_.isEmpty():
            break
        members = placed.drop("n").join(small(open_), "bucket")
        if not bounded:
            members, bounded = _bounded(compact(members, "ngram-members"), compared, similarity), True
            members = members.join(small(compact(nodes.select("node", "bands").join(
                small(members.select("node").distinct()), "node", "left_semi"), "ngram-open-bands")), "node")
        members = compact(members, "ngram-members")
        # members outside the bucket's main component, twice as many each round
        turn = F.row_number().over(W.partitionBy("bucket").orderBy("root", "node"))
        hubs = compact(
            members.where("root <> main").withColumn("turn", turn).where(F.col("turn") <= n_hubs).select(
                "bucket", F.col("node").alias("hub"), F.col("root").alias("hub_root"),
                *[F.col(c).alias(f"h_{c}") for c in ("size", "common", "own", "bands")]), "ngram-hubs")
        met = members.join(small(hubs), "bucket").where(
            (F.col("root") != F.col("hub_root")) & _may_be_similar(similarity) & _first_shared())
        pairs = (met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
                 .join(tested, ["a", "b"], "left_anti"))
        pairs = compact(pairs, "ngram-pairs")
        tested = tested.unionByName(pairs)
        found = compact(_links_of(_compared(pairs, texts, n, outside=False), similarity), "ngram-links")
        links = links.unionByName(found)
        roots = _merged(roots, found)
        # a hub has met all of its bucket
        members = members.drop("root", "main").join(
            small(hubs).select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")
        n_hubs *= 2
    return signed.select("id", "node"), links, roots, texts


def ngram_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True,
                  **options) -> DataFrame:
    """One row per input row: ``id_col``, ``class_id`` (smallest id of its
    class, null ids last), ``class_size`` (rows) and ``n_links`` (links of its
    n-gram set to different ones: all pairs of its class are compared). For
    classes alone ``count_links=False`` spares that; ``n_links`` is null then.

    A class is a connected component of links of ``similarity`` or more; rows
    with equal n-gram sets share all. A text of fewer than ``n`` words is one
    n-gram; null, empty and blank texts have none: each such row is a class of
    its own.
    """
    signed, _, roots, texts = _connected(docs, id_col, text_col, **options)
    if count_links:
        degree = compact(_degrees(roots, texts, options.get("n", 5), options.get("similarity", 0.8)), "ngram-degrees")
    else:
        degree = docs.sparkSession.createDataFrame([], "node binary, n_links long")
    no_link = F.lit(0 if count_links else None).cast("long")
    nodes = (signed.where("node IS NOT NULL").groupBy("node")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))).alias("low"))
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    nodes = compact(nodes, "ngram-nodes")
    classes = nodes.groupBy("root").agg(F.sum("n").alias("class_size"), F.min("low")["id"].alias("class_id"))
    facts = compact(nodes.select("node", "root").join(classes, "root").join(degree, "node", "left")
                        .select("node", "class_id", "class_size", F.coalesce("n_links", no_link).alias("n_links")),
                        "ngram-classes")
    placed = signed.where("node IS NOT NULL").join(facts, "node").select(
        F.col("id").alias(id_col), "class_id", "class_size", "n_links")
    alone = signed.where("node IS NULL").select(
        F.col("id").alias(id_col), F.col("id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"), no_link.alias("n_links"))
    return placed.unionByName(alone)
