"""Spelling variant grouping with bit-sliced position indexes.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Words meet in groups that agree on all letters outside a window, so
the one difference lies in the window. In a group every (window position,
letter) has a bitset over the group's words; a query word runs down its letters
and keeps, for 64 words at once, the words met without an error so far and the
words met with one error, the latter along positions shifted by -1, 0 and 1.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.operators.keys import dense_key
from starmart.session import materialize

# A letter is a-z (after lower-casing A-Z) or U+00C0 to U+00FF.
LETTER_CLASS = "a-zÀ-ÿ"
_LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
_GAP = re.compile(f"[^{LETTER_CLASS}]")
_NO_LETTER = len(_LETTERS)
_CODE = np.full(256, _NO_LETTER, np.uint8)
_CODE[np.frombuffer(_LETTERS.encode("latin-1"), np.uint8)] = np.arange(len(_LETTERS))

COUNT_SCHEMA = "word string, n long"
FOUND_SCHEMA = "rank long, n_near long, best long"


# words

def _blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts, none of which ends within a run of letters."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start:gap.start()]
        start = gap.end()
    yield text[start:]


def slipped(word: str, seed: int, every: int) -> str:
    """``word`` without one letter, where its checksum after ``seed`` says so."""
    h = zlib.crc32(word.encode("utf-8"), seed)
    return word if h % every else word[:h % len(word)] + word[h % len(word) + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                min_count: int = 5, slip_every: int | None = None, flush: int = 300_000) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points that occur at
    least ``min_count`` times in all texts.

    Words are maximal runs of letters, A-Z lower-cased. With ``slip_every`` a
    run is misspelt in documents where the crc32 of ``<id>:<run>`` is divisible
    by it: the letter at that checksum modulo the length is dropped. Null text
    has no words, a null id counts as empty. A task counts in a table of at most
    ``flush`` words and a block of a text, so long texts need no more memory.
    """
    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("id"),
                         F.col(text_col).cast("string").cast("binary").alias("text")).where("text IS NOT NULL")
    run = re.compile(f"[{LETTER_CLASS}]{{{min_length},}}")

    def as_batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                seed = zlib.crc32(doc_id.as_py() + b":")
                # bytes.lower() changes A-Z only
                for block in _blocks(text.as_py().lower().decode("utf-8", "replace")):
                    if slip_every is None:
                        counts.update(run.findall(block))
                    else:
                        for word, n in Counter(run.findall(block)).items():
                            counts[slipped(word, seed, slip_every)] += n
                    if len(counts) >= flush:
                        yield as_batch(counts)
                        counts.clear()
        yield as_batch(counts)

    return (source.mapInArrow(count, COUNT_SCHEMA).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# groups

def _keyed(spots: DataFrame) -> DataFrame:
    """(rank, role, a, w, key, letters) of spots (rank, word, role, a, b).

    A spot is the window [a, b) of the shorter word of a pair; in the role of
    the longer word (1) a word has one letter more in it. The key holds
    everything outside the window; long keys are hashed."""
    word, more = F.col("word"), F.col("role")
    outside = F.concat_ws(
        ":", F.length(word) - more, F.col("a"), F.col("b"),
        F.substring(word, F.lit(1), F.col("a")), F.substring(word, F.col("b") + more + 1, F.length(word)))
    return spots.select(
        "rank", "role", "a", (F.col("b") - F.col("a")).alias("w"),
        F.when(F.octet_length(outside) <= 64, outside).otherwise(F.sha2(outside, 256)).alias("key"),
        F.substring(word, F.col("a") + 1, F.col("b") - F.col("a") + more).alias("letters"))


def _spot(role: int, a: Column, b: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), a.cast("int").alias("a"), b.cast("int").alias("b"))


def _windows(vocab: DataFrame, min_length: int) -> DataFrame:
    """Both halves of every word, in the role of the shorter and of the longer word of a pair."""
    def halves(role: int) -> list[Column]:
        length = F.length("word") - role
        return [_spot(role, F.lit(0), F.floor(length / 2)), _spot(role, F.floor(length / 2), length)]

    longer = F.when(F.length("word") > min_length, F.array(*halves(1))).otherwise(F.slice(F.array(*halves(1)), 1, 0))
    return _keyed(vocab.select("rank", "word", F.explode(F.concat(F.array(*halves(0)), longer)).alias("spot"))
                  .select("rank", "word", "spot.*"))


def _split_large(rows: DataFrame, vocab: DataFrame, most: int, most_letters: int) -> DataFrame:
    """``rows`` with every group above the limits dealt into groups of half the
    window, again and again. One of the halves holds the difference, so no pair
    is lost; a window of one letter bounds its group by the alphabet."""
    done = []
    while True:
        large = materialize(
            rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("w") + 1).alias("letters"), F.max("w").alias("w"))
            .where(((F.col("n") > most) | (F.col("letters") > most_letters)) & (F.col("w") > 1)).select("key"),
            "spelling-large")
        if large.isEmpty():
            break
        side = checked_broadcast(large)
        done.append(rows.join(side, "key", "left_anti").select(*rows.columns))
        b, middle = F.col("a") + F.col("w"), F.col("a") + F.floor(F.col("w") / 2)
        parts = (rows.join(side, "key", "left_semi")
                 .select("rank", "role", F.explode(F.array(
                     F.struct("a", middle.cast("int").alias("b")),
                     F.struct(middle.cast("int").alias("a"), b.cast("int").alias("b")))).alias("spot")))
        rows = materialize(_keyed(parts.select("rank", "role", "spot.*").join(vocab.select("rank", "word"), "rank")),
                           "spelling-spots")
    for other in done:
        rows = rows.unionByName(other)
    return rows


# recurrences

def near_in_groups(starts: np.ndarray, ranks: np.ndarray, longer: np.ndarray, inner: np.ndarray,
                   letters: list[bytes], w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, number of near words, least rank among them) of words that have some.

    Words stand group by group (``starts``), by rank within a group; their
    ``letters`` (latin-1) number ``w``, or w + 1 where ``longer``. Pairs of two
    longer words meet in another group. Where a letter too many may stand at
    several places, the pair is counted in the window of the first: an
    ``inner`` window, which does not begin its word, leaves out pairs whose
    letter too many may be the window's first."""
    n = len(ranks)
    text = b"".join(x.ljust(w + 1, b"\0") for x in letters)
    codes = _CODE[np.frombuffer(text, np.uint8).reshape(n, w + 1)]
    slot = np.arange(n)
    lane, bit = slot >> 6, np.uint64(1) << (slot & 63).astype(np.uint64)
    n_lanes = (n + 63) >> 6

    def bits_of(which: np.ndarray) -> np.ndarray:
        out = np.zeros(n_lanes, np.uint64)
        np.bitwise_or.at(out, lane[which], bit[which])
        return out

    def index(i: int) -> np.ndarray:
        table = np.zeros((_NO_LETTER + 1, n_lanes), np.uint64)
        if 0 <= i <= w:
            np.bitwise_or.at(table, (codes[:, i], lane), bit)
            table[_NO_LETTER] = 0
        return table

    # one entry for each word and each lane that its group touches
    ends = np.append(starts[1:], n)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    low, high = starts[group], ends[group]
    touched = ((high - 1) >> 6) - (low >> 6) + 1
    first_entry = np.concatenate(([0], np.cumsum(touched)[:-1]))
    query = np.repeat(slot, touched)
    at = np.arange(len(query)) - first_entry[query] + (low[query] >> 6)
    full = ~np.uint64(0)
    mask = np.where(at == low[query] >> 6, full << (low[query] & 63).astype(np.uint64), full)
    mask &= np.where(at == (high[query] - 1) >> 6, full >> (63 - ((high[query] - 1) & 63)).astype(np.uint64), full)

    short_bits, long_bits = bits_of(~longer), bits_of(longer)
    near = np.zeros(len(query), np.uint64)
    for is_long in (False, True):
        entry = np.flatnonzero(longer[query] == is_long)
        q, l = query[entry], at[entry]
        zero = mask[entry].copy()  # no error so far
        replaced, added, dropped = (np.zeros(len(entry), np.uint64) for _ in range(3))
        at_first = zero.copy()  # the one letter too many is the window's first
        before, here, after = index(-1), index(0), index(1)
        for i in range(w + is_long):
            c = codes[q, i]
            same = here[c, l]
            if is_long:  # the found word lacks a letter of the query
                dropped = (dropped & before[c, l]) | zero
                if i:
                    at_first &= before[c, l]
            else:
                replaced = (replaced & same) | (zero & ~same)
                added = (added | zero) & after[c, l]  # the found word has a letter more
                at_first &= after[c, l]
            zero &= same
            before, here, after = here, after, index(i + 2)
        at_first = np.where(inner[q], at_first, np.uint64(0))
        if is_long:
            near[entry] = dropped & ~at_first & short_bits[l]
        else:
            near[entry] = (replaced & short_bits[l]) | ((added | zero) & ~at_first & long_bits[l])

    n_near = np.add.reduceat(np.bitwise_count(near).astype(np.int64), first_entry)
    lowest = near & (~near + np.uint64(1))
    lowest_slot = (at << 6) + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
    none = np.iinfo(np.int64).max
    best = np.minimum.reduceat(np.where(near > 0, ranks[np.minimum(lowest_slot, n - 1)], none), first_entry)
    some = n_near > 0
    return ranks[some], n_near[some], best[some]


def _search(batches: Iterator[pa.RecordBatch], most_entries: int = 1 << 18,
            most_letters: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Near words of rows sorted by (w, key, rank). A group is held whole; small
    groups of one window length are searched together."""
    held: pa.Table | None = None

    def settled(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch | pa.Table]:
        key = rows.column("key").combine_chunks()
        edges = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(edges) + 1))
        ends = np.append(starts[1:], len(key))
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        w = rows.column("w").to_numpy()
        entries = (ends - starts) * ((ends - starts) // 64 + 2)
        size = (ends - starts) * (w[starts] + 1) if len(starts) else ends
        g = 0
        while g < len(starts):
            to = g + 1
            total, letters = entries[g], size[g]
            while (to < len(starts) and w[starts[to]] == w[starts[g]] and total + entries[to] <= most_entries
                   and letters + size[to] <= most_letters):
                total, letters, to = total + entries[to], letters + size[to], to + 1
            part = rows.slice(starts[g], ends[to - 1] - starts[g])
            found = near_in_groups(
                starts[g:to] - starts[g], part.column("rank").to_numpy(), part.column("role").to_numpy() == 1,
                part.column("a").to_numpy() > 0, [x.encode("latin-1") for x in part.column("letters").to_pylist()],
                int(w[starts[g]]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["rank", "n_near", "best"])
            g = to
        yield rows.slice(ends[-1] if len(ends) else 0)

    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        *found, held = settled(held, False)
        yield from found
    if held is not None and held.num_rows:
        *found, _ = settled(held, True)
        yield from found


def near_words(vocab: DataFrame, min_length: int, most: int = 4096, most_letters: int = 1 << 24) -> DataFrame:
    """(rank, n_near, best) of the words of ``vocab`` (rank, word) that have near
    ones; ``best`` is the least rank among them. Only words of at least
    ``min_length`` (2 or more) letters may stand in ``vocab``."""
    rows = _split_large(materialize(_windows(vocab, min_length), "spelling-spots"), vocab, most, most_letters)
    found = (rows.repartition("key").sortWithinPartitions("w", "key", "rank").mapInArrow(_search, FOUND_SCHEMA))
    return found.groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(rank, root): the end of each chain in ``forms`` (rank, form). Every round
    doubles the steps taken; a form occurs several times as often as its word,
    so chains are short and never close."""
    reached = materialize(forms.select("rank", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = checked_broadcast(reached.select(F.col("rank").alias("root"), F.col("root").alias("next")))
        step = materialize(reached.join(further, "root", "left").select(
            "rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return reached
        reached = step.select("rank", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                      min_count: int = 5, ratio: int = 5, slip_every: int | None = None, flush: int = 300_000,
                      **limits) -> DataFrame:
    """One row per word (see ``count_words``): ``word``, ``form``, ``root``,
    ``n`` (occurrences), ``n_near`` (near words among all words), ``form_n``.

    A word's form is its near word with the most occurrences, of equal ones the
    first in code-point order, if it occurs at least ``ratio`` (over 1) times as
    often as the word; else null, and ``form_n`` too. The root is reached by
    following forms to the last, the word itself if it has none. Repeated rows
    count each time; a table without words gives an empty result.
    """
    if min_length < 2 or ratio <= 1:
        raise ValueError("words need two letters or more, forms a ratio above 1")
    counted = materialize(count_words(docs, id_col, text_col, min_length, min_count, slip_every, flush),
                          "spelling-words")
    # the least rank is the word with the most occurrences, then the first one
    vocab = materialize(dense_key(counted.select("word", "n", (-F.col("n")).alias("less")), ["less", "word"], "rank")
                        .select("rank", "word", "n"), "spelling-vocabulary")
    near = materialize(near_words(vocab.select("rank", "word"), min_length, **limits), "spelling-near")
    most = vocab.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    judged = materialize(
        vocab.join(near, "rank").join(most, "best")
        .select("rank", "n_near", *[F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c)
                                    for c in ("best", "form", "form_n")]), "spelling-forms")
    roots = last_forms(judged.where("best IS NOT NULL").select("rank", F.col("best").alias("form")))
    named = roots.join(vocab.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").drop("root")
    return (vocab.join(judged, "rank", "left").join(named, "rank", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
