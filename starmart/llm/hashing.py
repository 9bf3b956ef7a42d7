"""Word and word n-gram hashes of texts, as numpy arrays."""

from __future__ import annotations

import numpy as np

from starmart.llm.common import SPACES

MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)  # any fixed 64-bit values
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES.encode())] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(MULTIPLIER))
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(256)


def _hash_words(data: np.ndarray) -> np.ndarray:
    global _POWERS
    inside = ~_IS_SPACE[data]
    if not inside.any():
        return np.zeros(0, np.uint64)
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    at = np.flatnonzero(inside)
    lengths = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    place = at - np.repeat(starts, lengths)
    if (longest := int(lengths.max())) > len(_POWERS):
        _POWERS = _powers(2 * longest)
    # bytes drawn at random, weighed by their place in the word
    sums = np.add.reduceat(_BYTES[data[at]] * _POWERS[place], np.concatenate(([0], np.cumsum(lengths)[:-1])))
    return mix(sums + lengths.astype(np.uint64))


def word_hashes(text: str, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of every word, in order; a long text goes block by block,
    cut at white space."""
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    if len(data) <= block:
        return _hash_words(data)
    out, start = [], 0
    while start < len(data):
        end = min(start + block, len(data))
        while end < len(data):
            spaces = np.flatnonzero(_IS_SPACE[data[end:end + block]])
            end = end + int(spaces[0]) if len(spaces) else min(end + block, len(data))
            if len(spaces):
                break
        out.append(_hash_words(data[start:end]))
        start = end
    return np.concatenate(out)


def word_hashes_of_all(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of some short texts, one after the other, and how many each has."""
    parts = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    starts = np.flatnonzero(np.diff((~_IS_SPACE[data]).astype(np.int8), prepend=0) == 1)
    ends = np.cumsum([len(p) + 1 for p in parts])
    return _hash_words(data), np.diff(np.searchsorted(starts, ends), prepend=0)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; a shorter text is one run; none if empty."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, np.uint64(n))
    for i in range(n):
        out = out * np.uint64(MULTIPLIER) + words[i:len(words) - n + 1 + i]
    return mix(out)
