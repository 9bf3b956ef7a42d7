"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the hash of its stripped, ASCII-lower-cased bytes. The index
keeps which document holds which key (references), an exact table of counts
(key, documents, smallest id), and per shard of the key space a cuckoo filter of
the keys that have a count. Inserting documents asks the filters first: a key they
do not hold is certainly new, so its count is written as it is; only hits are
looked up in the count table and in the references. Deleting documents takes
their references out, counts the keys they held anew, and keys that nobody holds
any more leave the filter, so inserts and deletions undo each other.

All tables only grow by a generation a change: rows of counts supersede earlier
ones of their key, deleted ids earlier references of theirs, and a shard's filter
the one before. A change writes what it touches.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import SPACES, text_or_empty
from starmart.operators.joins import checked_broadcast
from starmart.session import materialize, scratch_path

SLOTS = 4  # fingerprints per bucket
MAX_ROUNDS = 200


def line_key(line: str, min_chars: int) -> bytes | None:
    """16 bytes naming the line, or None if its key is under ``min_chars``."""
    bare = line.strip(SPACES)
    if len(bare) < min_chars:
        return None
    # bytes.lower changes A-Z only
    return hashlib.blake2b(bare.encode("utf-8").lower(), digest_size=16).digest()


class CuckooFilter:
    """Cuckoo filter over 64-bit hashes, all operations on whole arrays.

    Tables double: when a table does not take every key, the rest goes to a new
    one of at least the same size. A key is in the filter if a table holds its
    16-bit fingerprint in one of the key's two buckets; deleting takes one copy
    out. No false negatives for keys that were inserted and not deleted.
    """

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    @staticmethod
    def _places(hashes: np.ndarray, n_buckets: int):
        h = hashes.astype(np.uint64)
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1  # 0 marks a free slot
        first = (h & np.uint64(n_buckets - 1)).astype(np.int64)
        return print_, first, CuckooFilter._other(print_, first, n_buckets)

    @staticmethod
    def _other(print_: np.ndarray, bucket: np.ndarray, n_buckets: int) -> np.ndarray:
        spread = print_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        return bucket ^ (spread & np.uint64(n_buckets - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), dtype=bool)
        for table in self.tables:
            print_, a, b = self._places(hashes, len(table))
            found |= ((table[a] == print_[:, None]) | (table[b] == print_[:, None])).any(axis=1)
        return found

    @staticmethod
    def _fill(table: np.ndarray, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put fingerprints in free slots of their buckets; which found one."""
        order = np.argsort(bucket, kind="stable")
        place = bucket[order]
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        turn = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(place))))
        free = table[place] == 0
        slot_order = np.argsort(~free, axis=1, kind="stable")  # free slots first
        fits = turn < free.sum(axis=1)
        slot = slot_order[np.arange(len(place)), np.minimum(turn, SLOTS - 1)]
        table[place[fits], slot[fits]] = print_[order][fits]
        done = np.zeros(len(bucket), dtype=bool)
        done[order[fits]] = True
        return done

    def _insert_into(self, table: np.ndarray, hashes: np.ndarray) -> bool:
        """Insert all, or leave the table as it was."""
        before = table.copy()
        print_, bucket, _ = self._places(hashes, len(table))
        for round_ in range(MAX_ROUNDS):
            if len(print_):
                left = ~self._fill(table, print_, bucket)
                print_, bucket = print_[left], bucket[left]
            if not len(print_):
                return True
            if round_:  # both buckets were full: one per bucket takes a victim's slot
                _, one = np.unique(bucket, return_index=True)
                slot = (print_[one].astype(np.int64) + round_) % SLOTS
                victims = table[bucket[one], slot].copy()
                table[bucket[one], slot] = print_[one]
                print_ = print_.copy()
                print_[one] = victims
            bucket = self._other(print_, bucket, len(table))
        table[:] = before
        return False

    def insert(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        if not (self.tables and self._insert_into(self.tables[-1], hashes)):
            wanted = max(len(hashes) / (SLOTS * 0.8), len(self.tables[-1]) if self.tables else 1, 16)
            table = np.zeros((1 << int(np.ceil(np.log2(wanted))), SLOTS), dtype=np.uint16)
            while not self._insert_into(table, hashes):
                table = np.zeros((2 * len(table), SLOTS), dtype=np.uint16)
            self.tables.append(table)

    def delete(self, hashes: np.ndarray) -> None:
        """Take one copy of each hash out; only of hashes that were inserted."""
        left = hashes
        for table in reversed(self.tables):
            for which in (1, 2):
                if len(left):
                    places = self._places(left, len(table))
                    left = left[~self._take_out(table, places[0], places[which])]

    @staticmethod
    def _take_out(table: np.ndarray, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Free one slot for each fingerprint in its bucket; which had one there."""
        order = np.lexsort((print_, bucket))
        place, mark = bucket[order], print_[order]
        # those alike in bucket and fingerprint take a copy each, in turn
        first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (mark[1:] != mark[:-1]))))
        turn = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
        there = table[place] == mark[:, None]
        hit = turn < there.sum(axis=1)
        slot = np.argsort(~there, axis=1, kind="stable")[np.arange(len(place)), np.minimum(turn, SLOTS - 1)]
        table[place[hit], slot[hit]] = 0
        done = np.zeros(len(bucket), dtype=bool)
        done[order[hit]] = True
        return done

    def to_bytes(self) -> bytes:
        head = np.array([len(self.tables), *map(len, self.tables)], dtype=np.int64)
        return head.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, raw: bytes | None) -> "CuckooFilter":
        if not raw:
            return cls()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes, at, tables = np.frombuffer(raw, np.int64, n, 8), 8 * (n + 1), []
        for size in sizes:
            tables.append(np.frombuffer(raw, np.uint16, int(size) * SLOTS, at).reshape(-1, SLOTS).copy())
            at += int(size) * SLOTS * 2
        return cls(tables)


def _hashes(keys: pd.Series) -> np.ndarray:
    """The 64 bits of each key that the filter uses (the shard uses others)."""
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)[:, 0] if len(keys) else np.zeros(0, np.uint64)


class LineIndex:
    """Which documents hold which lines, with inserts and deletions.

    ``root`` is a folder on shared storage. ``shards`` bounds a task's work:
    one shard's distinct keys of a change and its filter lie in one task.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, shards: int = 16, min_chars: int = 10):
        self.spark, self.shards, self.min_chars = spark, shards, min_chars
        self.root = root or scratch_path(spark, "line-index")
        self.generation = 0
        # folders: references, first counts of keys, counts that supersede others, deleted ids, filters
        self.at: dict[str, list[str]] = {k: [] for k in ("refs", "fresh", "again", "gone", "filters")}

    # state

    def _add(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` as the next generation of ``table``, listed at the change's end."""
        at = f"{self.root}/{table}/{self.generation}-{uuid.uuid4().hex[:12]}"
        df.withColumn("gen", F.lit(self.generation)).write.parquet(at)
        self._pending.append((table, at))
        return self.spark.read.parquet(at)

    def _begin(self) -> None:
        self.generation += 1
        self._pending: list[tuple[str, str]] = []

    def _commit(self) -> None:
        for table, at in self._pending:
            self.at[table].append(at)

    def _table(self, table: str) -> DataFrame | None:
        return self.spark.read.parquet(*self.at[table]) if self.at[table] else None

    def references(self) -> DataFrame | None:
        """(id, key, shard) of every line key and document in the index."""
        refs, gone = self._table("refs"), self._table("gone")
        if refs is None or gone is None:
            return refs if refs is None else refs.select("id", "key", "shard")
        deleted = gone.groupBy("gone_id").agg(F.max("gen").alias("gone_gen"))
        return refs.join(checked_broadcast(deleted), F.col("id").eqNullSafe(F.col("gone_id"))
                         & (F.col("gen") < F.col("gone_gen")), "left_anti").select("id", "key", "shard")

    def _filters(self) -> DataFrame:
        filters = self._table("filters")
        if filters is None:
            return self.spark.createDataFrame([], "shard int, filter binary")
        return filters.groupBy("shard").agg(F.max_by("filter", "gen").alias("filter"))

    def counts(self, min_docs: int = 1) -> DataFrame:
        """(key, n_docs, first_id): reference count and smallest id of the keys that
        ``min_docs`` documents or more hold; a null id comes after all others.

        First counts are read as they were written, except for keys of which a
        later row is there. So keys that were never hit are not shuffled."""
        fresh, again = self._table("fresh"), self._table("again")
        columns = ["key", "n_docs", F.col("first.id").alias("first_id")]
        enough = F.col("n_docs") >= min_docs
        if again is None:
            return fresh.where(enough).select(*columns)
        last = materialize(again.groupBy("key").agg(F.max_by(F.struct("n_docs", "first"), "gen").alias("c"),
                                                    F.max("gen").alias("last_gen")), "line-again")
        late = last.select(F.col("key").alias("late_key"), "last_gen")
        # the filter lets a key be new again only after its last document has gone
        valid = fresh.where(enough).join(checked_broadcast(late), (F.col("key") == F.col("late_key"))
                                         & (F.col("gen") < F.col("last_gen")), "left_anti")
        return valid.select(*columns).unionByName(
            last.select("key", "c.*").where(enough & (F.col("n_docs") > 0)).select(*columns))

    # lines

    def lines_of(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, text_hash, key) of each row's distinct long lines; the hash names
        the row's text among those that share its id."""
        source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
            "id", F.xxhash64("text").alias("text_hash"), "text")
        min_chars = self.min_chars

        def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows, out = [], []
                for at, text in enumerate(batch["text"]):
                    found = {line_key(line, min_chars) for line in text.split("\n")} - {None}
                    rows.extend([at] * len(found))
                    out.extend(found)
                yield pd.DataFrame({"id": batch["id"].iloc[rows].array, "text_hash": batch["text_hash"].iloc[rows].array,
                                    "key": out})

        schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("text_hash", T.LongType()),
                               T.StructField("key", T.BinaryType())])
        return source.mapInPandas(keys, schema)

    # changes

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def _change_filters(self, keys: DataFrame, change) -> None:
        """Apply ``change`` to the filters of the shards of ``keys`` (key, shard)."""
        keys = materialize(keys, "line-changed")
        filters = self._filters().join(checked_broadcast(keys.select("shard").distinct()), "shard", "left_semi")
        self._add(keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
            change, "shard int, filter binary"), "filters")

    @staticmethod
    def _counted(lines: DataFrame) -> DataFrame:
        """Counts of (id, key, shard) rows, each there once; combined map-side."""
        return lines.groupBy("key", "shard").agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))).alias("first"))

    def insert(self, lines: DataFrame) -> None:
        """Add references (``lines_of``); ones already there count once."""
        self._begin()
        lines = materialize(lines.select("id", "key", self._shard().alias("shard")).distinct(), "line-new")
        old = self.references()
        counted = materialize(self._counted(lines), "line-counted")
        if old is None:
            new, refs = counted, lines
        else:
            probed = materialize(
                counted.select("key", "shard").groupBy("shard").cogroup(self._filters().groupBy("shard")).applyInPandas(
                    _probe, "key binary, shard int, maybe boolean"), "line-probed")
            # a key the filter does not hold is new, with all its references
            new = counted.join(probed.where("NOT maybe").select("key"), "key", "left_semi")
            hits = checked_broadcast(materialize(probed.where("maybe").select("key"), "line-hits"))
            known = materialize(old.join(hits, "key", "left_semi").select(
                F.col("id").alias("known_id"), F.col("key").alias("known_key")), "line-known")
            is_known = (F.col("key") == F.col("known_key")) & F.col("id").eqNullSafe(F.col("known_id"))
            refs = lines.join(known, is_known, "left_anti")
            # hits are counted exactly, with what the count table has of them
            more = self._counted(refs.join(hits, "key", "left_semi"))
            before = self.counts().join(hits, "key", "left_semi").select(
                F.col("key").alias("b_key"), F.col("n_docs").alias("b_docs"), F.col("first_id").alias("b_id"))
            b_first = F.when(F.col("b_key").isNotNull(), F.struct(F.col("b_id").isNull().alias("no_id"), F.col("b_id").alias("id")))
            self._add(more.join(before, F.col("key") == F.col("b_key"), "left").select(
                "key", "shard", (F.col("n_docs") + F.coalesce("b_docs", F.lit(0))).alias("n_docs"),
                F.least("first", b_first).alias("first")), "again")
            # of the hits, those without a count were false alarms of the filter
            missed = materialize(more.join(before, F.col("key") == F.col("b_key"), "left_anti").select("key", "shard"), "line-missed")
        self._add(new.select("key", "shard", "n_docs", "first"), "fresh")
        self._add(refs, "refs")
        keys = new.select("key", "shard")
        self._change_filters(keys if old is None else keys.unionByName(missed), _insert)
        self._commit()

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out again: their references, and from the filters the
        keys that no document holds any more."""
        old = self.references()
        if old is None:
            return
        self._begin()
        gone = self._add(ids.select(F.col(id_col).alias("gone_id")).distinct(), "gone")
        is_gone = F.col("id").eqNullSafe(F.col("gone_id"))
        # keys that lose a document are counted anew, from their references alone
        touched = materialize(old.join(checked_broadcast(gone.select("gone_id")), is_gone, "left_semi")
                              .select("key", "shard").distinct(), "line-touched")
        side = checked_broadcast(touched.select("key"))
        left = old.join(side, "key", "left_semi").join(checked_broadcast(gone.select("gone_id")), is_gone, "left_anti")
        now = self._counted(left)
        no_one = F.lit(None).cast(now.schema["first"].dataType)
        counted = self._add(now.unionByName(
            touched.join(left.select("key").distinct(), "key", "left_anti")
            .select("key", "shard", F.lit(0).cast("long").alias("n_docs"), no_one.alias("first"))), "again")
        self._change_filters(counted.where("n_docs = 0").select("key", "shard"), _delete)
        self._commit()

    # answers

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_docs: int = 2, lines: DataFrame | None = None) -> DataFrame:
        """One row per input row: ``id_col``, ``n_lines``, ``n_dropped`` and
        ``kept_text``, the lines that stay joined by a line feed. ``lines``:
        ``lines_of(docs)``, where the caller has it. The keys that a row loses are
        gathered by its id and text, so no group is larger than a text."""
        min_chars = self.min_chars
        source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn(
            "text_hash", F.xxhash64("text"))
        lines = self.lines_of(docs, id_col, text_col) if lines is None else lines
        repeated = checked_broadcast(materialize(self.counts(min_docs), "line-repeated"))
        dropped = (lines.join(repeated, "key").where(~F.col("id").eqNullSafe(F.col("first_id")))
                   .groupBy(F.col("id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash"))
                   .agg(F.collect_set("key").alias("keys")))
        joined = source.join(dropped, F.col("id").eqNullSafe(F.col("dropped_id"))
                             & (F.col("text_hash") == F.col("dropped_hash")), "left").select("id", "text", "keys")

        def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                n_lines, n_dropped, kept = [], [], []
                for text, keys in zip(batch["text"], batch["keys"]):
                    lines = text.split("\n")
                    if keys is None:
                        stay = lines
                    else:
                        gone = set(map(bytes, keys))
                        stay = [x for x in lines if line_key(x, min_chars) not in gone]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                    kept.append("\n".join(stay))
                yield pd.DataFrame({"id": batch["id"].array, "n_lines": np.array(n_lines, dtype=np.int64),
                                    "n_dropped": np.array(n_dropped, dtype=np.int64), "kept_text": kept})

        schema = T.StructType([T.StructField("id", source.schema["id"].dataType),
                               T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                               T.StructField("kept_text", T.StringType())])
        return joined.mapInPandas(strip, schema).withColumnRenamed("id", id_col)


def _old_filter(filters: pd.DataFrame) -> CuckooFilter:
    return CuckooFilter.from_bytes(filters["filter"].iloc[0] if len(filters) else None)


def _probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    return keys[["key", "shard"]].assign(maybe=_old_filter(filters).contains(_hashes(keys["key"])))


def _changed(keys: pd.DataFrame, filters: pd.DataFrame, change) -> pd.DataFrame:
    kept = _old_filter(filters)
    change(kept, _hashes(keys["key"]))
    shard = (keys if len(keys) else filters)["shard"].iloc[0]
    return pd.DataFrame({"shard": np.array([shard], dtype=np.int32), "filter": [kept.to_bytes()]})


def _insert(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    return _changed(keys, filters, CuckooFilter.insert)


def _delete(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    return _changed(keys, filters, CuckooFilter.delete)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2,
               min_chars: int = 10, min_docs: int = 2, keys_per_shard: int = 1 << 17) -> DataFrame:
    """Index ``docs`` in ``batches`` inserts and return ``LineIndex.clean``.

    Lines whose key has ``min_chars`` code points or more and lies in
    ``min_docs`` documents or more stay only in the one with the smallest id.
    Null and empty texts are one empty line. Rows with equal ids are one
    document: their lines count once and stay or go together; a null id counts
    as one document after all others. The result does not depend on batches.
    """
    index = LineIndex(docs.sparkSession, min_chars=min_chars)
    found = materialize(index.lines_of(docs, id_col, text_col), "lines")
    index.shards = max(index.shards, -(-found.count() // keys_per_shard))
    for i in range(batches):
        index.insert(found.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i))
    return index.clean(docs, id_col, text_col, min_docs, found)
