"""Scans of Arrow text buffers: byte classes, spans, span hashes and exact distinct counts, in numpy.

Everything works on the UTF-8 bytes of many texts end to end and their n + 1 offsets
(``common.utf8_buffers``). Separators are ASCII, so spans of bytes are spans of characters.
Memory beyond a few bytes per byte of text is bounded by ``PIECE``, whatever a text's length.
"""

from __future__ import annotations

import hashlib

import numpy as np

from .common import mix64

#: Bytes that are hashed or compared at once.
PIECE = 1 << 18
_ODD = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE + 1, base, np.uint64)
    out[0] = 1
    return out.cumprod(dtype=np.uint64)


_POWERS, _INVERSE = _powers(_ODD), _powers(pow(_ODD, -1, 1 << 64))


def byte_class(members: bytes) -> np.ndarray:
    """A table of 256 flags that is true for ``members``."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: The separators of the contracts' words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANK = byte_class(b" \t\n\v\f\r")
CAPITAL = byte_class(bytes(range(ord("A"), ord("Z") + 1)))
#: Bytes that begin a code point.
LEADING = byte_class(bytes([*range(0x80), *range(0xC0, 0x100)]))


def count_class(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Bytes of a class in each text, by prefix sums."""
    total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal runs without separators; runs end with their text."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    first, last = offsets[filled], offsets[filled + 1] - 1
    begins[first], ends[last] = inside[first], inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; equal spans have equal hashes, the converse is for ``repeats`` to verify."""
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        stop = int(np.searchsorted(end, low + PIECE, "right"))
        if stop <= at:  # a span longer than a piece
            out[at] = int.from_bytes(hashlib.blake2b(data[low : int(end[at])], digest_size=8).digest(), "little")
            at += 1
            continue
        a, b = start[at:stop] - low, end[at:stop] - low
        weighted = (data[low : int(end[stop - 1])].astype(np.uint64) + np.uint64(1)) * _POWERS[: int(end[stop - 1]) - low]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        out[at:stop] = mix64((total[b] - total[a]) * _INVERSE[a] + (b - a).astype(np.uint64))
        at = stop
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``a`` equal those at ``b``, for each pair."""
    same = np.ones(len(a), bool)
    total = np.cumsum(size)
    at = 0
    while at < len(a):
        done = int(total[at - 1]) if at else 0
        stop = max(int(np.searchsorted(total, done + PIECE, "right")), at + 1)
        if stop == at + 1:
            same[at] = np.array_equal(data[a[at] : a[at] + size[at]], data[b[at] : b[at] + size[at]])
        else:
            part = size[at:stop]
            pair = np.repeat(np.arange(stop - at), part)
            step = np.arange(int(part.sum())) - np.repeat(np.cumsum(part) - part, part)
            differs = data[a[at:stop][pair] + step] != data[b[at:stop][pair] + step]
            same[at + np.unique(pair[differs])] = False
        at = stop
    return same


def repeats(data: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """Spans of each text that repeat an earlier one of the same text, so distinct ones are the rest.

    Hashes are sorted by text and neighbours with equal hashes are compared byte by byte; a
    text in which different spans share a hash is counted again by the spans themselves.
    """
    order = np.lexsort((hashes, text))
    left, right = order[:-1], order[1:]
    equal = (text[left] == text[right]) & (hashes[left] == hashes[right])
    left, right = left[equal], right[equal]
    size = end - start
    sure = size[left] == size[right]
    sure[sure] = same_bytes(data, start[left[sure]], start[right[sure]], size[left[sure]])
    out = np.bincount(text[left], minlength=texts)
    for t in np.unique(text[left[~sure]]).tolist():
        a, b = np.searchsorted(text, [t, t + 1])
        out[t] = b - a - len({data[i:j].tobytes() for i, j in zip(start[a:b].tolist(), end[a:b].tolist())})
    return out
