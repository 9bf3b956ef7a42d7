"""Token counts of byte-level BPE by rank-synchronous array merging.

The distinct pre-tokens of a batch lie end to end in one numpy array with
their start offsets. A round looks up the rank of every adjacent pair, finds
each sequence's lowest rank, merges that pair wherever it occurs in its
sequence, in all sequences at once, and drops sequences without a mergeable
pair. What survives is counted, not decoded.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how byte-level BPE cuts a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int64).max


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    itself if it is printable, else the next free one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class TokenCounter:
    """Counts tokens of texts under a byte-level BPE tokenizer file."""

    def __init__(self, path: str, cache_size: int = 400_000, block: int = 1 << 20):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.byte_ids = np.array([vocab[c] for c in _byte_symbols()], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.stride = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.stride + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.rank_of, self.made = keys[order], order, made[order]
        self.pattern = regex.compile(PRE_TOKEN)
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.cache: dict[str, int] = {}
        self.cache_size, self.block = cache_size, block

    def merged_lengths(self, tokens: list[str]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        raw = [t.encode("utf-8") for t in tokens]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ids = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        out, rows = lengths.copy(), np.arange(len(raw))
        while len(rows):
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            # pair k is (ids[k], ids[k + 1]); a sequence's last symbol has none
            key = np.full(len(ids), -1, dtype=np.int64)
            key[:-1] = ids[:-1] * self.stride + ids[1:]
            key[starts + lengths - 1] = -1
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)
            lowest = np.minimum.reduceat(rank, starts)
            left = (rank == np.repeat(lowest, lengths)) & (rank != NO_RANK)
            # overlapping occurrences (aaa) merge from the left: every other one of a run
            index = np.arange(len(ids))
            run_start = np.where(left & ~np.concatenate(([False], left[:-1])), index, -1)
            left &= (index - np.maximum.accumulate(run_start)) % 2 == 0
            ids = np.where(left, self.made[at], ids)
            stays = ~np.concatenate(([False], left[:-1]))
            lengths = np.add.reduceat(stays.astype(np.int64), starts)
            out[rows] = lengths
            alive = (lowest != NO_RANK) & (lengths > 1)
            keep = stays & np.repeat(alive, np.diff(np.append(starts, len(stays))))
            ids, rows, lengths = ids[keep], rows[alive], lengths[alive]
        return out

    def _learn(self, tokens: Iterable[str]) -> None:
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        new = list(set(tokens).difference(self.cache))
        for i in range(0, len(new), 200_000):
            part = new[i:i + 200_000]
            self.cache.update(zip(part, self.merged_lengths(part).tolist()))

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special tokens, a block at a time."""
        if len(text) <= self.block:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, self.block // 4)):
            yield part

    def counts(self, texts: Iterable[str]) -> list[int]:
        """Number of tokens of each text."""
        out: list[int] = []
        held: list[tuple[int, list[str]]] = []
        n_held = 0

        def settle() -> None:
            nonlocal n_held
            self._learn(t for _, part in held for t in part)
            for k, part in held:
                out[k] += sum(map(self.cache.__getitem__, part))
            held.clear()
            n_held = 0

        for k, text in enumerate(texts):
            pieces = self.special.split(text) if self.special else [text]
            out.append(len(pieces) - 1)  # each special string is one token
            for piece in pieces:
                for part in self._blocks(piece):
                    held.append((k, part))
                    n_held += len(part)
                    if n_held >= self.block // 4:
                        settle()
        settle()
        return out


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)  # once per Python worker


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit`` (more than ``limit`` tokens).

    Null text counts as empty (0 bytes, 0 tokens). ``tokenizer_path`` is read
    on every executor. Special strings of the tokenizer inside a text are one
    token each. A text of any length is held in blocks of pre-tokens.
    """
    source = docs.select(F.col(id_col).alias("id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for batch in batches:
            text = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.binary_length(text.cast(pa.binary())).cast(pa.int64()),
                 pa.array(counter.counts(t.as_py() for t in text), pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    return source.mapInArrow(count, schema).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
