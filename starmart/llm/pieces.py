"""SentencePiece encoding with seeded merge dropout, and its decoding.

Merges run as the agenda of a merge-type model runs them: the best-scored
candidate first, the leftmost of equals, each popped once. A popped candidate
is skipped when a hash of its place falls under the dropout, so a text gets
another segmentation under another seed, and the same one on every run. Words
are independent of each other in the agenda (no piece crosses from a word into
the next one's space mark), so a batch advances the agendas of all its
distinct words together, one pop each a round, in flat numpy arrays; occurrences
of a word for which a candidate is skipped run their own. Decoding
gives back every text exactly.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import text_or_empty
from starmart.llm.hashing import MULTIPLIER, mix

MARK = "▁"  # fixed value: stands for a space in pieces
HELD = "\ud800"  # stands for a MARK of the text itself: no text can hold a lone surrogate
NO_RANK = np.int32(np.iinfo(np.int32).max)
CHAR = 1 << 21  # symbols from here on are single characters without a piece
LONG = 64  # longer words run their agenda on a heap, alone
M64 = (1 << 64) - 1


class PieceModel:
    """Vocabulary of a merge-type SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        probe = " ﬁ  x"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK) or not model.is_byte(model.piece_to_id("<0x41>")):
            raise ValueError("the model must keep texts as they are, with a space put first and bytes for unknown characters")
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        piece = {model.id_to_piece(i): i for i in plain}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        # a character's symbol: its piece, or itself
        self.symbol = np.arange(CHAR, CHAR + 0x110000, dtype=np.int64)
        for text, i in piece.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i

        def symbol(text: str) -> int | None:
            return int(self.symbol[ord(text)]) if len(text) == 1 else piece.get(text)

        levels = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}
        for text, i in piece.items():
            for cut in range(1, len(text)):
                a, b = symbol(text[:cut]), symbol(text[cut:])
                if a is not None and b is not None:
                    pairs[a << 22 | b] = (levels[model.get_score(i)], i)
        self.pairs = pairs
        # the same as an open-addressed table, for whole arrays of pairs
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_rank, self.slot_made = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        keys = np.array(list(pairs), np.int64)
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) & self.last
            self.slot_key[slot] = key
            self.slot_rank[slot], self.slot_made[slot] = pairs[key]
        self.bytes = {i: t.replace(MARK, " ").encode() for t, i in piece.items()}
        self.bytes |= {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        # where a text may be cut without losing a merge: before a run of space
        # marks, and around characters that no longer piece holds
        joined = {c for t in piece if len(t) > 1 for c in t}
        alone = HELD + "".join(c for c in "\n\t\r\x0b\x0c" if c not in joined)
        crossing = any(re.search(f"[^{MARK}]{MARK}", t) for t in piece)
        cut = f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+"
        self.cut = re.compile("[\\s\\S]+" if crossing else cut)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(MULTIPLIER) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK: no merge) and result of merging symbols."""
        key = left.astype(np.int64) << 22 | right
        slot = self._slot(key)
        held = self.slot_key[slot]
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):  # taken by another pair: the next slot
            slot[open_] = (slot[open_] + 1) & self.last
            now = self.slot_key[slot[open_]]
            held[open_] = now
            open_ = open_[(now != key[open_]) & (now >= 0)]
        return np.where(held == key, self.slot_rank[slot], NO_RANK), self.slot_made[slot]


class Encoder:
    """Encodes with one seed and dropout. Each occurrence of a word has a key of
    its document and place, which with the candidate's place fixes whether a
    candidate is skipped."""

    def __init__(self, model: PieceModel, dropout: float, seed: int):
        self.model, self.seed = model, seed
        self.under = min(M64, int(dropout * 2.0 ** 64)) if dropout > 0 else 0

    # keyed hash of a candidate: word key, and where its left part starts, its
    # right part starts, and its right part ends

    def _skips(self, key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
        m = np.uint64(MULTIPLIER)
        place = (start.astype(np.uint64) * m + mid.astype(np.uint64)) * m + end.astype(np.uint64)
        return mix((place * m) ^ key) < np.uint64(self.under)

    def _word_sums(self, code: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        place = (np.arange(len(code)) - np.repeat(starts, lengths)).astype(np.uint64)
        return np.add.reduceat(mix(code * np.uint64(MULTIPLIER) + place), starts)

    def _keys(self, sums: np.ndarray, stream: np.ndarray) -> np.ndarray:
        return mix(sums ^ mix(stream.astype(np.uint64) + np.uint64((self.seed * MULTIPLIER + 1) & M64)))

    def encode_words(self, words: list[str], stream: np.ndarray | None,
                     log: list[tuple] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words end to end, and the number of each word's.
        Without ``stream`` no candidate is skipped, and ``log`` takes the popped
        ones (word, and three places) and last the words' sums."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        sums = self._word_sums(code, starts, lengths)
        keys = None if stream is None else self._keys(sums, stream)
        symbols = self.model.symbol[code.astype(np.int64)]
        results: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, count, symbols of finished ones
        short = np.flatnonzero(lengths <= LONG)
        for w in np.flatnonzero(lengths > LONG):
            done = self._heap(symbols[starts[w]:starts[w] + lengths[w]].tolist(), None if keys is None else keys[w], w, log)
            results.append((np.array([w]), np.array([len(done)]), np.array(done, np.int64)))
        if len(short):
            self._agendas(short, symbols[np.repeat(lengths <= LONG, lengths)], lengths[short],
                          None if keys is None else keys[short], results, log)
        if log is not None:
            log.append(sums)
        word = np.concatenate([r[0] for r in results])
        count = np.concatenate([r[1] for r in results])
        flat = np.concatenate([r[2] for r in results])
        # back to the words' order
        order = np.argsort(word, kind="stable")
        begin = np.concatenate(([0], np.cumsum(count)[:-1]))[order]
        count = count[order]
        return self._with_bytes(flat[_ranges(begin, count)], count)

    def _agendas(self, rows, sym, lengths, keys, results, log) -> None:
        """Agendas of short words side by side. Per symbol: where it starts in
        its word, its word, and the candidate of it and its right neighbour."""
        size = lengths.astype(np.int32)  # characters of each word
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        word = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
        at = (np.arange(len(sym)) - starts[word]).astype(np.int32)
        sym = sym.astype(np.int32)
        rank, made = self.model.look_up(sym[:-1], sym[1:])
        rank, made = np.append(rank, NO_RANK), np.append(made, np.int32(0))
        rank[starts + lengths - 1] = NO_RANK
        while len(sym):
            best = np.minimum.reduceat(rank, starts)
            if (best == NO_RANK).any():
                live = best != NO_RANK
                keep = live[word]
                ended = ~keep
                results.append((rows[~live], lengths[~live], sym[ended].astype(np.int64)))
                sym, at, rank, made = sym[keep], at[keep], rank[keep], made[keep]
                rows, lengths, size, best = (v[live] for v in (rows, lengths, size, best))
                keys = None if keys is None else keys[live]
                if not len(rows):
                    return
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                word = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
            k = np.flatnonzero(rank == best[word])
            owner = word[k]
            k = k[np.concatenate(([True], owner[1:] != owner[:-1]))]  # each word's leftmost best candidate
            if self.under and (keys is not None or log is not None):
                end = np.where(k + 2 < starts + lengths, at[np.minimum(k + 2, len(at) - 1)], size)
            if keys is None and log is not None:
                log.append((rows, at[k], at[k + 1], end))
            if self.under and keys is not None:
                skip = self._skips(keys, at[k], at[k + 1], end)
                rank[k[skip]] = NO_RANK
                k = k[~skip]
                if not len(k):
                    continue
                lengths = lengths - ~skip
            else:
                lengths = lengths - 1
            sym[k] = made[k]
            stay = np.ones(len(sym), bool)
            stay[k + 1] = False
            # candidates on both sides of a merged symbol are new ones
            changed = np.zeros(len(sym), bool)
            changed[k] = True
            changed[np.maximum(k - 1, 0)] = True
            sym, at, rank, made, word, changed = (v[stay] for v in (sym, at, rank, made, word, changed))
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            k = np.flatnonzero(changed)
            rank[k], made[k] = self.model.look_up(sym[k], sym[np.minimum(k + 1, len(sym) - 1)])
            rank[starts + lengths - 1] = NO_RANK

    def _heap(self, sym: list[int], key: np.uint64 | None, word: int, log: list[tuple] | None) -> list[int]:
        """The agenda of one word, for long ones: n log n in its characters."""
        popped = []
        n, pairs = len(sym), self.model.pairs
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda: list[tuple] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (hit := pairs.get(sym[i] << 22 | sym[j])):
                heapq.heappush(agenda, (hit[0], i, j, sym[i], sym[j], hit[1]))

        for i in range(n):
            offer(i)
        one = None if key is None else np.array([key], np.uint64)
        while agenda:
            _, i, j, a, b, new = heapq.heappop(agenda)
            if sym[i] != a or after[i] != j or sym[j] != b:
                continue  # a part was merged since
            if log is not None:
                popped.append((i, j, after[j]))
            if self.under and one is not None and self._skips(one, np.array([i]), np.array([j]), np.array([after[j]]))[0]:
                continue
            sym[i], sym[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        if popped:
            log.append((np.full(len(popped), word), *np.array(popped).T))
        return [s for s in sym if s >= 0]

    def _with_bytes(self, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their UTF-8 bytes."""
        strange = sym >= CHAR
        if not strange.any():
            return sym, count
        cp = np.where(strange, sym - CHAR, 0)
        cp[cp == ord(HELD)] = ord(MARK)
        width = 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
        out = np.repeat(sym, width)
        raw = np.frombuffer("".join(map(chr, cp[strange].tolist())).encode("utf-8"), np.uint8)
        out[np.repeat(strange, width)] = self.model.byte_ids[raw]
        word = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(word, weights=width, minlength=len(count)).astype(np.int64)

    def encode(self, texts: list[str], doc_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts end to end, and the number of each text's."""
        place = _Places()
        items: list[np.ndarray] = []
        turns: list[np.ndarray] = []
        for text, doc in zip(texts, doc_keys):
            # no space mark is put before an empty text
            marked = MARK + text.replace(MARK, HELD).replace(" ", MARK) if text else ""
            words = self.model.cut.findall(marked)
            items.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
            turns.append(mix(np.arange(len(words), dtype=np.uint64) * np.uint64(MULTIPLIER) + doc))
        if not place:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        words, log = list(place), [] if self.under else None
        flat, count = self.encode_words(words, None, log)
        wanted = np.concatenate(items)
        if self.under and len(own := self._varied(wanted, np.concatenate(turns), log)):
            # occurrences with a skipped candidate, some at a time
            for start in range(0, len(own), 1 << 16):
                part = own[start:start + (1 << 16)]
                more, sizes = self.encode_words([words[w] for w in wanted[part]], np.concatenate(turns)[part])
                wanted[part] = len(count) + np.arange(len(part))
                flat, count = np.concatenate((flat, more)), np.concatenate((count, sizes))
        begin = np.concatenate(([0], np.cumsum(count)[:-1]))
        ends = np.cumsum([0, *map(len, items)])
        per_text = np.diff(np.concatenate(([0], np.cumsum(count[wanted])))[ends])
        return flat[_ranges(begin[wanted], count[wanted])], per_text

    def _varied(self, wanted: np.ndarray, turns: np.ndarray, log: list) -> np.ndarray:
        """Occurrences (of the words ``wanted``) for which some candidate that
        their word pops without dropout is skipped."""
        sums, popped = log[-1], log[:-1]
        if not popped:
            return np.zeros(0, np.int64)
        word, start, mid, end = (np.concatenate([p[i] for p in popped]) for i in range(4))
        order = np.argsort(word, kind="stable")
        start, mid, end = start[order], mid[order], end[order]
        many = np.bincount(word, minlength=len(sums))
        first = np.concatenate(([0], np.cumsum(many)[:-1]))
        keys, total, out = self._keys(sums[wanted], turns), np.cumsum(many[wanted]), []
        at = 0
        while at < len(wanted):  # about a million candidates at a time
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
            w = wanted[at:stop]
            which = _ranges(first[w], many[w])
            owner = np.repeat(np.arange(at, stop), many[w])
            out.append(np.unique(owner[self._skips(keys[owner], start[which], mid[which], end[which])]))
            at = stop
        return np.concatenate(out)


class _Places(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), then the same for the next."""
    total = int(count.sum())
    shift = begin - np.concatenate(([0], np.cumsum(count)[:-1]))
    return np.arange(total) + np.repeat(shift, count)


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)  # once per Python worker


def encode_pieces(docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 0,
                  id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1 << 20,
                  copy_col: str | None = None) -> DataFrame:
    """One row per input row: ``id_col`` and ``pieces`` (array of ids).

    Same id, text, seed and dropout, same pieces, unless ``copy_col`` numbers a
    document's copies; dropout 0 gives the model's
    own segmentation, 1 single characters. Null and empty texts have no pieces.
    Characters without a piece go as UTF-8 bytes, and so does a space mark that
    stands in the text itself, so any text decodes to itself. ``model_path`` is
    read on every executor.
    """
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                         F.xxhash64(*[c for c in (id_col, copy_col) if c is not None]).alias("doc_key"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType),
                           T.StructField("pieces", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_model(model_path), dropout, seed)
        for batch in batches:
            text, ids = batch.column("text"), batch.column("id")
            keys = batch.column("doc_key").to_numpy().astype(np.uint64)
            size = pc.binary_length(text).to_pylist()
            start = 0
            while start < len(size):  # a block of texts at a time, one at least
                end, held = start + 1, size[start]
                while end < len(size) and held + size[end] <= block_bytes:
                    held += size[end]
                    end += 1
                flat, count = encoder.encode(text.slice(start, end - start).to_pylist(), keys[start:end])
                offsets = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))],
                    names=["id", "pieces"])
                start = end

    return source.mapInArrow(encode, schema).withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id",
                  pieces_col: str = "pieces", carry: bool = False) -> DataFrame:
    """One row per input row: ``id_col`` and ``text``, with ``carry`` also
    ``pieces``. Null pieces are none; ids that stand for no text (begin, end,
    unknown) decode to nothing."""
    source = encoded.select(F.col(id_col).alias("id"), F.col(pieces_col).alias("pieces"))
    fields = [source.schema["id"], *([source.schema["pieces"]] if carry else []), T.StructField("text", T.StringType())]
    names = [f.name for f in fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _model(model_path).bytes
        known = np.array([table.get(i, b"") for i in range(max(table) + 1)], dtype=object)
        for batch in batches:
            texts = []
            for ids in batch.column("pieces"):
                raw = b"".join(known[ids.values.to_numpy()]) if ids.is_valid else b""
                # the space that encoding put first
                texts.append(raw.removeprefix(b" ").decode("utf-8", "replace"))
            kept = [batch.column(n) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=names)

    return source.mapInArrow(decode, T.StructType(fields)).withColumnRenamed("id", id_col)
