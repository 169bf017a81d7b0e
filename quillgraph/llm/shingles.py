"""Word shingles of many texts at once, straight from their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from .common import mix64, random_table

WORDS = 5
_BYTE = random_table(256, 11)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z in lower case
_BASE = np.uint64(random_table(1, 12)[0] | np.uint64(1))
_PLACE = random_table(WORDS, 13) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the n + 1 word offsets of the texts."""
    if not data.size:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    kept = data[inside]
    place = np.arange(kept.size) - np.repeat(first, lengths)
    parts = _BYTE[kept] * _powers(int(lengths.max(initial=0)))[place]
    hashes = mix64(np.add.reduceat(parts, first) + lengths.astype(np.uint64)) if first.size else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text end to end, and their n + 1 offsets.

    A text of fewer than five words has one shingle, its whole sequence; a text without
    words has none.
    """
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    full = np.zeros(words.size, np.uint64)
    for k in range(WORDS):
        full += padded[k : k + words.size] * _PLACE[k]
    full = mix64(full + np.uint64(WORDS))
    sizes = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if ends.size else 0, np.uint64)
    for i, (a, n, size, end) in enumerate(zip(at.tolist(), counts.tolist(), sizes.tolist(), ends.tolist())):
        if n >= WORDS:
            part = out[end - size : end]
            part[:] = full[a : a + size]
            part.sort()
        elif n:
            out[end - 1] = mix64((words[a : a + n] * _PLACE[:n]).sum(keepdims=True) + np.uint64(n))[0]
    new = np.ones(out.size, bool)
    new[1:] = out[1:] != out[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    distinct = np.concatenate([[0], np.cumsum(new)])
    return out[new], np.concatenate([[0], distinct[ends]]) if ends.size else np.zeros(1, np.int64)
