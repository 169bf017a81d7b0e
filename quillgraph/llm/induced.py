"""External induced sorting of suffixes with common prefixes.

Suffixes come out of priority queues whose key is (first symbol, order of insertion):
one first-in-first-out queue per symbol, taken in symbol order. A suffix that leaves a
queue induces the suffix before it, if that is of the wanted type, into the queue of its
symbol. A tuple carries the suffix and the common prefix with its neighbour in the queue,
capped at ``depth``: of two induced neighbours it is one more than the least of those between
the suffixes that induced them (a range minimum), and one if these begin with different
symbols. Queues keep their tuples in memory up to a budget and beyond it in a file that has
no name (it is gone with the task); all steps are blocks of numpy operations. The text, two
bytes for each suffix, and the positions and names of the S* suffixes are held in memory, so
the caller deals what is larger over cells (``suffix_dedup``).

Types: a suffix is S if it is smaller than the one behind it, else L; an S behind an L is
S*. The S* suffixes are sorted by recursion: their substrings are sorted by induction and
named, and the string of names is ranked by doubling. As only ``depth`` symbols matter to
the caller, doubling stops once names span that much; suffixes equal that far may come in
any order. Where the induction begins (neighbours among S* suffixes) and where the L
suffixes of a symbol meet its S suffixes, common prefixes are compared in the text.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

from .common import mix64, random_table

#: Tuples that leave a queue at once.
BLOCK = 1 << 19
#: A tuple is position << BITS | common prefix.
BITS = 8


class Store:
    """Memory budget and spill file that the queues of one sort share."""

    def __init__(self, budget: int):
        self.budget, self.held, self.file, self.end = budget, 0, None, 0

    def write(self, data: np.ndarray) -> tuple[int, int]:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        self.file.write(data.tobytes())
        at, self.end = self.end, self.end + data.nbytes
        return at, len(data)

    def take(self, part: np.ndarray | tuple[int, int]) -> np.ndarray:
        if isinstance(part, np.ndarray):
            self.held -= part.nbytes
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(8 * part[1]), np.int64)


class Queue:
    """Queue of tuples, in memory or in the store's file; ``started`` once anything was in it."""

    def __init__(self, store: Store):
        self.store, self.parts, self.started = store, deque(), False

    def push(self, data: np.ndarray) -> None:
        if not len(data):
            return
        self.started = True
        if self.store.held + data.nbytes > self.store.budget:
            for a in range(0, len(data), BLOCK):
                self.parts.append(self.store.write(data[a : a + BLOCK]))
        else:
            self.store.held += data.nbytes
            self.parts.append(data)

    def pop(self) -> np.ndarray | None:
        """The next block from the front, None if the queue is empty."""
        found, size = [], 0
        while self.parts and size < BLOCK:
            found.append(self.store.take(self.parts.popleft()))
            size += len(found[-1])
        return np.concatenate(found) if found else None

    def pop_last(self) -> np.ndarray | None:
        """The part at the back."""
        return self.store.take(self.parts.pop()) if self.parts else None


class _Minima:
    """Range minima of small numbers."""

    def __init__(self, values: np.ndarray):
        self.levels = [values.astype(np.uint8)]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum from first to last, both included."""
        out = np.empty(len(first), np.uint8)
        level = np.log2(last - first + 1).astype(np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << k) + 1])
        return out


class _Inducer:
    """Routes induced tuples, in order, to the queues of their symbols."""

    def __init__(self, text: np.ndarray, depth: int, symbols: int):
        self.text, self.depth = text, depth
        self.pending = np.zeros(symbols, np.int64)

    def begin(self) -> None:
        """A new first symbol: what was induced before shares nothing with what comes."""
        self.pending[:] = 0

    def route(self, positions: np.ndarray, common: np.ndarray, wanted: np.ndarray, queues: list[Queue]) -> None:
        """Induce the suffix before each position with ``wanted``; ``common``: with the tuple before, in order."""
        sources = np.flatnonzero(wanted)
        if not self.depth:
            lcp = np.zeros(len(sources), np.int64)
        if len(sources):
            before = positions[sources] - 1
            symbols = self.text[before]
            order = np.argsort(symbols, kind="stable")
            symbols, before, sources = symbols[order], before[order], sources[order]
            cuts = np.flatnonzero(np.diff(symbols)) + 1
            firsts = np.concatenate([[0], cuts])
            if self.depth:
                lcp = np.empty(len(sources), np.int64)
                inner = np.ones(len(sources), bool)
                inner[firsts] = False
                at = np.flatnonzero(inner)
                lcp[at] = _Minima(common).of(sources[at - 1] + 1, sources[at]) if len(at) else 0
                running = np.minimum.accumulate(common)
                lcp[firsts] = np.minimum(self.pending[symbols[firsts]], running[sources[firsts]])
                lcp = np.minimum(lcp + 1, self.depth)
            for first, last in zip(firsts.tolist(), [*cuts.tolist(), len(symbols)]):
                queue = queues[int(symbols[first])]
                if self.depth and not queue.started:
                    lcp[first] = 0
                queue.push(before[first:last] << BITS | lcp[first:last])
        if self.depth and len(common):
            seen = np.zeros(len(self.pending), bool)
            if len(sources):
                lasts = np.concatenate([cuts, [len(symbols)]]) - 1
                behind = np.append(np.minimum.accumulate(common[::-1])[::-1], self.depth)
                self.pending[symbols[lasts]] = behind[sources[lasts] + 1]
                seen[symbols[lasts]] = True
            self.pending[~seen] = np.minimum(self.pending[~seen], common.min())


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S. The last symbol must be smaller than all others."""
    ends = np.flatnonzero(text[:-1] != text[1:])
    kinds = np.append(text[ends] < text[ends + 1], True)
    lengths = np.diff(np.concatenate([[-1], ends, [len(text) - 1]]))
    return np.repeat(kinds, lengths)


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, at most ``depth``, compared symbol by symbol."""
    out = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    for k in range(depth):
        p, q = a[left] + k, b[left] + k
        inside = np.maximum(p, q) < len(text)
        same = np.zeros(len(left), bool)
        same[inside] = text[p[inside]] == text[q[inside]]
        left = left[same]
        if not left.size:
            break
        out[left] += 1
    return out


def induce(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, depth: int, store: Store) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, in blocks, with the common prefix each has with the one before it.

    ``seeds`` are the S* suffixes (ascending). Without ``depth`` no common prefixes are carried.
    """
    symbols = int(text.max()) + 1
    starred, growing, ended, shrinking = ([Queue(store) for _ in range(symbols)] for _ in range(4))
    between = np.zeros(len(seeds), np.int64)
    if depth and len(seeds) > 1:
        between[1:] = common_prefixes(text, seeds[:-1], seeds[1:], depth)
    heads = text[seeds]
    order = np.argsort(heads, kind="stable")
    cuts = np.flatnonzero(np.diff(heads[order])) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(seeds)]):
        if last > first:
            own = order[first:last]
            starred[int(heads[own[0]])].push(seeds[own] << BITS | between[own])
    mask = (1 << BITS) - 1
    inducer = _Inducer(text, depth, symbols)
    for c in range(symbols):  # L suffixes, ascending
        inducer.begin()
        latest = -1
        for queue, l_part in ((growing[c], True), (starred[c], False)):
            meeting = not l_part
            while (block := queue.pop()) is not None:
                positions, common = block >> BITS, block & mask
                if meeting:
                    common[0] = common_prefixes(text, np.array([latest]), positions[:1], depth)[0] if latest >= 0 else 0
                    meeting = False
                latest = int(positions[-1])
                if l_part:
                    ended[c].push(block)
                wanted = positions > 0
                wanted[wanted] = ~is_s[positions[wanted] - 1]
                inducer.route(positions, common, wanted, growing)
    inducer = _Inducer(text, depth, symbols)
    for c in range(symbols - 1, -1, -1):  # S suffixes, descending
        inducer.begin()
        latest, following = -1, None
        while (block := shrinking[c].pop()) is not None:
            positions, common = block >> BITS, block & mask
            latest = int(positions[-1])
            yield positions, common
            wanted = positions > 0
            wanted[wanted] = is_s[positions[wanted] - 1]
            inducer.route(positions, common, wanted, shrinking)
        while (block := ended[c].pop_last()) is not None:
            block = block[::-1]
            positions, stored = block >> BITS, block & mask
            if following is None:
                following = int(common_prefixes(text, np.array([latest]), positions[:1], depth)[0]) if latest >= 0 else 0
            common = np.concatenate([[following], stored[:-1]])  # with the next greater one
            following = int(stored[-1])
            yield positions, common
            wanted = positions > 0
            wanted[wanted] = is_s[positions[wanted] - 1]
            inducer.route(positions, common, wanted, shrinking)
    yield np.array([len(text) - 1]), np.array([0])  # nothing behind it induces the last suffix


def _named(text: np.ndarray, starred: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Name of each S* substring (ascending with its order), by text order of ``starred``."""
    ends = np.append(starred[1:], len(text) - 1)
    table = random_table(int(text.max()) + 1, 31)
    lengths = ends - starred + 1
    key = np.zeros(len(starred), np.uint64)
    left, k = np.arange(len(starred)), 0
    while left.size:  # symbols of the substrings, one place after another
        key[left] = mix64(key[left] * np.uint64(0x9E3779B97F4A7C15) + table[text[starred[left] + k]])
        k += 1
        left = left[lengths[left] > k]
    key += lengths.astype(np.uint64)
    rank = np.searchsorted(starred, ordered)
    new = np.ones(len(ordered), np.int64)
    new[1:] = key[rank[1:]] != key[rank[:-1]]
    names = np.empty(len(starred), np.int64)
    names[rank] = np.cumsum(new)
    return names


def sort_starred(text: np.ndarray, is_s: np.ndarray, depth: int, store: Store) -> np.ndarray:
    """S* suffixes, ascending by ``depth`` symbols at least."""
    starred = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(starred) < 2:
        return starred
    mark = np.zeros(len(text), bool)
    mark[starred] = True
    blocks = [b[mark[b]][::-1] for b, _ in induce(text, is_s, starred, 0, store)]
    names = _named(text, starred, np.concatenate(blocks[::-1]))
    span = 1
    while (top := int(names.max())) < len(names) and span < depth:
        behind = np.zeros(len(names), np.int64)
        behind[: max(0, len(names) - span)] = names[span:]
        pair = names * (top + 1) + behind
        order = np.argsort(pair, kind="stable")
        new = np.ones(len(pair), np.int64)
        new[1:] = pair[order[1:]] != pair[order[:-1]]
        names = np.empty(len(pair), np.int64)
        names[order] = np.cumsum(new)
        span *= 2
    return starred[np.argsort(names, kind="stable")]


def suffix_blocks(text: np.ndarray, depth: int, budget: int | Store = 1 << 28) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefixes) of all suffixes in descending order (by ``depth`` symbols at least), in blocks.

    ``text`` holds small non-negative integers; its last symbol is smaller than all others.
    Each common prefix is that with the suffix before, in descending order, capped at ``depth``
    (below 2**BITS). ``budget``: bytes of tuples kept in memory, or the store of the queues.
    """
    if not 0 < depth < 1 << BITS:
        raise ValueError("depth must fit the tuples")
    if not len(text):
        return
    is_s = suffix_types(text)
    store = Store(budget) if isinstance(budget, int) else budget
    yield from induce(text, is_s, sort_starred(text, is_s, depth, store), depth, store)
