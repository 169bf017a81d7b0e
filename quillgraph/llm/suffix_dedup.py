"""Repeated passages by suffix sorting.

Every byte that lies in a ``LENGTH``-byte string which also starts in a document with a
smaller doc_id is removed. Strings are judged on the input and never cross documents.

1. Documents are packed into batches, once, so that later steps can address them.
2. Each window of LENGTH bytes has an anchor, its smallest k-byte gram by hash; windows
   that share an anchor form a segment. Equal windows have equal anchors, so a segment
   whose anchor occurs in one document only cannot repeat. A shuffle of anchor hashes
   alone (aggregated within a batch) tells which are shared, and which are hot: the windows of
   a hot anchor become segments of their own, whose anchor is their own hash.
3. Segments with shared anchors are shuffled by anchor. Equal segments (their bytes are
   compared) collapse: all but those of the smallest doc_id are removed whole. What differs
   goes through external induced sorting (``induced``); neighbours in suffix order whose common
   prefix, capped at LENGTH, is LENGTH are equal windows, and all but those of the smallest
   doc_id go.
4. Ranges to remove return to their batches and are applied.

A shuffle has lanes, ranges of anchors, one for each task. A lane may be far larger than
memory: its task keeps what comes up to ``SPOOL_BYTES`` and beyond that deals it over cells
(smaller ranges of anchors) in an unnamed file of its own, which is gone with the task; cells
then go through memory one after another. There are at most ``MAX_LANES`` lanes, so a batch
sends at most that many parts, and parts of ``GROUP_BATCHES`` batches travel together.

Defined results: null and empty texts lose nothing; rows of one doc_id never remove from
each other; a null doc_id counts as greater than all others; texts shorter than LENGTH
bytes lose nothing; whole texts are read, however long; repeated rows give repeated results;
of equal strings under one smallest doc_id all stay; cutting inside a character is possible, so
kept text is bytes; an empty table gives no rows; columns other than doc_id and text may have
any name.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Accumulator, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, steps, sub_batches, text_rows, utf8_buffers
from .induced import Store, suffix_blocks

LENGTH = 50
#: Bytes of an anchor gram (a multiple of 8), and grams in a window. Longer grams are shared less by chance.
GRAM = 24
SPAN = LENGTH - GRAM + 1
#: Text bytes of a batch, and batches whose parts of a lane travel in one blob.
BATCH_BYTES, GROUP_BATCHES = 1 << 20, 16
#: Text bytes of the input for each cell and for each lane; lanes at most.
CELL_BYTES, LANE_BYTES, MAX_LANES = 6 << 20, 64 << 20, 4096
#: Occurrences from which an anchor is hot.
HOT = 4096
#: Bytes of a lane, and of suffix tuples, that a task keeps in memory.
SPOOL_BYTES, SORT_BYTES = 32 << 20, 1 << 26
#: Bytes of flags that are broadcast at most; beyond that their join is shuffled.
BROADCAST_BYTES = 32 << 20
_NO_ID = (1 << 63) - 1
_CHUNK = 1 << 19
#: Positions that are hashed at once, so that their arrays stay in the processor's cache.
_HASHED = 1 << 16
_WINDOW = np.uint64(0xA24BAED4963EE407)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays end to end, with their sizes and types, compressed."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, "<i8", len(types) + 1)[1:].tolist()
    out, at = [], 8 * (len(types) + 1)
    for kind, size in zip(types, sizes):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    n = data.size - GRAM + 1
    if n > 2 * _HASHED:
        out = np.empty(n, np.uint64)
        for a in range(0, n, _HASHED):
            out[a : a + _HASHED] = _grams(data[a : min(a + _HASHED, n) + GRAM - 1])
        return out
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | x[width:] << np.uint64(8 * width)
    out = mix64(x[:n])
    for k in range(8, GRAM, 8):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n])
    return out


def _segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows, document) of every segment of a batch.

    Long texts go in chunks; a segment cut there stays right, as segments only group windows.
    """
    anchors, firsts, counts, owners = [], [], [], []
    n = data.size - LENGTH + 1  # windows, before those across documents go
    whose = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for begin in range(0, max(n, 0), _HASHED):
        end = min(begin + _HASHED, n)
        grams = _grams(data[begin : end - 1 + LENGTH])
        place = np.arange(grams.size, dtype=np.uint64)
        key = grams >> np.uint64(22) << np.uint64(22) | place  # the first of equal grams is smallest
        width = 1
        while 2 * width <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < SPAN:
            key = np.minimum(key[: key.size - (SPAN - width)], key[SPAN - width :])
        at = (key & np.uint64((1 << 22) - 1)).astype(np.int64)
        window = np.arange(begin, end)
        owner = whose[begin:end]
        valid = window + LENGTH <= offsets[1:][owner]
        at, window, owner = at[valid], window[valid], owner[valid]
        if not at.size:
            continue
        new = np.ones(at.size, bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        anchors.append(mix64(grams[at[starts]]))  # smallest hashes are no even key for shards, so they are mixed anew
        firsts.append(window[starts])
        counts.append(np.diff(np.append(starts, at.size)))
        owners.append(owner[starts])
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return join(anchors, np.uint64), join(firsts, np.int64), join(counts, np.int64), join(owners, np.int64)


def _part(anchor: np.ndarray, parts: int) -> np.ndarray:
    """The range of anchors, of ``parts`` equal ones, that each lies in."""
    return ((anchor >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _spots(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of ranges, one range after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _present(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, first, end) of the runs of an ascending array; parts without entries cost nothing."""
    cuts = np.flatnonzero(np.diff(part)) + 1
    bounds = [0, *cuts.tolist(), len(part)] if len(part) else []
    for a, b in zip(bounds, bounds[1:]):
        yield int(part[a]), a, b


class Columns:
    """Rows as arrays. A ragged column holds the values of all rows end to end; a fixed one has their numbers."""

    def __init__(self, fixed: list[np.ndarray], ragged: list[np.ndarray], lengths: tuple[int, ...]):
        self.fixed, self.ragged, self.lengths = fixed, ragged, lengths

    def __len__(self) -> int:
        return len(self.fixed[0])

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (*self.fixed, *self.ragged))

    def take(self, rows: np.ndarray) -> Columns:
        ragged = []
        for values, k in zip(self.ragged, self.lengths):
            size = self.fixed[k].astype(np.int64)
            ragged.append(values[_spots((np.cumsum(size) - size)[rows], size[rows])])
        return Columns([a[rows] for a in self.fixed], ragged, self.lengths)

    @staticmethod
    def join(parts: list[Columns]) -> Columns:
        if len(parts) == 1:
            return parts[0]
        together = lambda arrays: [np.concatenate(x) for x in zip(*arrays)]
        return Columns(together([p.fixed for p in parts]), together([p.ragged for p in parts]), parts[0].lengths)

    def dump(self) -> bytes:
        return _pack(*self.fixed, *self.ragged)


#: Distinct anchors of a batch: bits 16 to 47 and 48 to 63 of the anchor, whether several ids have it, occurrences.
HASHES = (("<u4", "<u2", "?", "<u2"), (), ())
#: Distinct segments of a batch: anchor, smallest id, batch, bytes, rows with it; their bytes, and where those rows begin.
SEGMENTS = (("<u8", "<i8", "<i8", "u1", "<u4"), ("u1", "<u4"), (3, 4))


def _load(blob: bytes, form: tuple) -> Columns:
    fixed, ragged, lengths = form
    arrays = _unpack(blob, *fixed, *ragged)
    return Columns(arrays[: len(fixed)], arrays[len(fixed) :], lengths)


class Spool:
    """Rows of a lane, dealt over cells by their first column, an anchor: in memory up to a budget, then in a file."""

    def __init__(self, form: tuple, cells: int, budget: int):
        self.form, self.cells, self.budget = form, cells, budget
        self.parts: list[Columns] = []
        self.held = self.end = 0
        self.file, self.places = None, {}

    def add(self, part: Columns) -> None:
        self.parts.append(part)
        self.held += part.nbytes
        if self.held > self.budget:
            self._spill()

    def _cut(self) -> Iterator[tuple[int, Columns]]:
        if not self.parts:
            return
        whole = Columns.join(self.parts)
        self.parts, self.held = [], 0
        cell = _part(whole.fixed[0], self.cells)
        order = np.argsort(cell, kind="stable")
        for k, a, b in _present(cell[order]):
            yield k, whole.take(order[a:b])

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for cell, part in self._cut():
            blob = part.dump()
            self.file.seek(self.end)
            self.file.write(blob)
            self.places.setdefault(cell, []).append((self.end, len(blob)))
            self.end += len(blob)

    def __iter__(self) -> Iterator[Columns]:
        """Rows of one cell after another."""
        if self.file is None:
            yield from (part for _, part in self._cut())
            return
        self._spill()
        for cell in sorted(self.places):
            parts = []
            for at, size in self.places[cell]:
                self.file.seek(at)
                parts.append(_load(self.file.read(size), self.form))
            yield Columns.join(parts)
        self.file.close()


class _Sender:
    """Parts of batches by lane, sent together every GROUP_BATCHES batches."""

    def __init__(self, every: int):
        self.every, self.parts, self.batches = every, {}, 0

    def add(self, lane: int, number: int, part: Columns) -> None:
        self.parts.setdefault(lane, []).append((number, part))

    def end_batch(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        self.batches += not last
        if self.parts and (last or self.batches % self.every == 0):
            lanes = sorted(self.parts)
            blobs = []
            for lane in lanes:
                numbers, parts = zip(*self.parts[lane])
                whole = Columns.join(list(parts))
                blobs.append(_pack(np.array(numbers, "<i8"), np.array([len(p) for p in parts], "<i8"), *whole.fixed, *whole.ragged))
            self.parts = {}
            yield pa.RecordBatch.from_arrays([pa.array(lanes, pa.int32()), pa.array([None] * len(lanes), pa.int64()), pa.array(blobs, pa.binary())], ["lane", "batch", "blob"])


def _received(blob: bytes, form: tuple) -> tuple[np.ndarray, np.ndarray, Columns]:
    """(numbers of batches, rows of each, all their rows) of a sender's blob."""
    fixed, ragged, lengths = form
    numbers, sizes, *arrays = _unpack(blob, "<i8", "<i8", *fixed, *ragged)
    return numbers, sizes, Columns(arrays[: len(fixed)], arrays[len(fixed) :], lengths)


class Plan:
    """Lanes and cells for ``total`` text bytes, and the budgets of a task."""

    def __init__(self, total: int, least: int):
        self.lanes = max(least, min(MAX_LANES, -(-total // LANE_BYTES)))
        self.cells = self.lanes * max(1, -(-total // (self.lanes * CELL_BYTES)))
        self.every, self.hot, self.spool, self.sort = GROUP_BATCHES, HOT, SPOOL_BYTES, SORT_BYTES


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """batch, size, ids, lengths, text: documents packed, those of a batch in order of id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in sub_batches(batches, "text", BATCH_BYTES):
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            data, offsets = utf8_buffers(batch.column("text"))
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            blob = _pack(ids, batch.column("doc_id").is_null().to_numpy(zero_copy_only=False), np.diff(offsets), data)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([data.size]), pa.array([blob])], ["batch", "size", "blob"])
            number += 1

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "batch long, size long, blob binary")


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, whether null, offsets, bytes) of a batch."""
    ids, null, lengths, data = _unpack(blob, "<i8", "?", "<i8", "u1")
    return ids, null, np.concatenate([[0], np.cumsum(lengths)]), data


def _distinct(anchor: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors (ascending), whether each occurs under several ids, and how often."""
    order = np.argsort(anchor, kind="stable")
    a, i = anchor[order], ids[order]
    new = np.ones(a.size, bool)
    new[1:] = a[1:] != a[:-1]
    starts = np.flatnonzero(new)
    if not starts.size:
        return a, np.zeros(0, bool), starts
    return a[starts], np.minimum.reduceat(i, starts) != np.maximum.reduceat(i, starts), np.diff(np.append(starts, a.size))


def _shared_anchors(packed: DataFrame, plan: Plan, spilled: Accumulator | None) -> DataFrame:
    """batch, flags: for each batch and lane, which of its distinct anchors occur in several documents, and which are hot.

    Ids are compared within a batch; an anchor found in two batches counts as shared, which
    may only be too much, as may one whose last 16 bits alone differ from another's.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(plan.every)
        for batch in batches:
            for number, blob in zip(batch.column("batch").to_pylist(), batch.column("blob").to_pylist()):
                ids, _, offsets, data = _open(blob)
                anchor, _, _, owner = _segments(data, offsets)
                distinct, several, times = _distinct(anchor, ids[owner])
                times = np.minimum(times, 65535).astype("<u2")
                for lane, a, b in _present(_part(distinct, plan.lanes)):
                    key = distinct[a:b]
                    sender.add(lane, number, Columns([(key >> np.uint64(16)).astype("<u4"), (key >> np.uint64(48)).astype("<u2"), several[a:b], times[a:b]], [], ()))
                yield from sender.end_batch()
        yield from sender.end_batch(last=True)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool = Spool((("<u8", "?", "<u2", "<i8"), (), ()), plan.cells, plan.spool)
        lanes, numbers, sizes, total = [], [], [], 0
        for batch in batches:
            for lane, blob in zip(batch.column("lane").to_pylist(), batch.column("blob").to_pylist()):
                of, size, rows = _received(blob, HASHES)
                low, high, several, times = rows.fixed
                key = low.astype(np.uint64) << np.uint64(16) | high.astype(np.uint64) << np.uint64(48)
                spool.add(Columns([key, several, times, total + np.arange(len(rows))], [], ()))
                lanes.append(np.full(len(of), lane, np.int32))
                numbers.append(of)
                sizes.append(size)
                total += len(rows)
        if not total:
            return
        shared, hot = _task_array(total, plan.spool), _task_array(total, plan.spool)
        for cell in spool:
            key, several, times, place = cell.fixed
            order = np.argsort(key, kind="stable")
            key, several, times, place = key[order], several[order], times[order].astype(np.int64), place[order]
            new = np.ones(key.size, bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            count = np.diff(np.append(starts, key.size))
            shared[place] = several | np.repeat(count > 1, count)
            hot[place] = np.repeat(np.add.reduceat(times, starts) >= plan.hot, count)
        if spilled is not None:
            spilled.add(spool.end)
        lane, number, size = np.concatenate(lanes), np.concatenate(numbers), np.concatenate(sizes)
        ends = np.cumsum(size)
        for a, b in steps(size, 1 << 24):
            bits = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends[a:b].tolist(), size[a:b].tolist())]
            hots = [np.packbits(hot[e - n : e]).tobytes() if hot[e - n : e].any() else b"" for e, n in zip(ends[a:b].tolist(), size[a:b].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(number[a:b]), pa.array(lane[a:b]), pa.array(bits, pa.binary()), pa.array(hots, pa.binary())], ["batch", "lane", "shared", "hot"])

    hashes = packed.select("batch", "blob").mapInArrow(emit, "lane int, batch long, blob binary")
    flags = hashes.repartitionById(plan.lanes, "lane").mapInArrow(match, "batch long, lane int, shared binary, hot binary")
    # One entry for each lane, so the list is bounded.
    return flags.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("lane", "shared", "hot"))).alias("flags"))


def _task_array(size: int, budget: int) -> np.ndarray:
    """Zeros, in memory up to a budget, else in an unnamed file of the task."""
    if size <= budget:
        return np.zeros(size, bool)
    return np.memmap(tempfile.TemporaryFile(), bool, "w+", shape=(size,))


def _collapse(content: np.ndarray, ids: np.ndarray, tie: np.ndarray, data: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): segments ordered by content and id, and where in that order others of equal bytes begin.

    Segments whose keys are equal are compared byte by byte, each with the one before it.
    """
    order = np.lexsort((tie, ids, content))
    new = np.ones(order.size, bool)
    new[1:] = content[order[1:]] != content[order[:-1]]
    again = np.flatnonzero(~new)
    if again.size:
        a, b = order[again], order[again - 1]
        new[again] = length[a] != length[b]
        again = again[length[a] == length[b]]
        for p, q in steps(length[order[again]], _CHUNK):
            a, b = order[again[p:q]], order[again[p:q] - 1]
            starts = np.cumsum(length[a]) - length[a]
            new[again[p:q]] = np.logical_or.reduceat(data[_spots(first[a], length[a])] != data[_spots(first[b], length[b])], starts)
    return order, new


def _shared_segments(packed: DataFrame, flags: DataFrame, plan: Plan) -> DataFrame:
    """lane, batch, blob: segments with shared anchors; rows with a batch hold its ranges to remove already.

    Within a batch, equal segments are kept for their smallest id only; the others are
    ranges to remove. Windows of hot anchors are segments of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(plan.every)
        for batch in batches:
            for number, blob, bits in zip(*(batch.column(c).to_pylist() for c in ("batch", "blob", "flags"))):
                ids, _, offsets, data = _open(blob)
                anchor, first, count, owner = _segments(data, offsets)
                distinct, _, _ = _distinct(anchor, ids[owner])
                runs = list(_present(_part(distinct, plan.lanes)))
                if not runs:
                    continue
                unpacked = lambda name: np.concatenate([np.unpackbits(np.frombuffer(f[name], np.uint8))[: b - a] if f[name] else np.zeros(b - a, np.uint8) for f, (_, a, b) in zip(bits, runs)]).astype(bool)  # noqa: E731, B023
                at = np.searchsorted(distinct, anchor)
                keep, hot = unpacked("shared")[at], unpacked("hot")[at]
                grams = _grams(data)
                split, keep = np.flatnonzero(keep & hot), np.flatnonzero(keep & ~hot)
                window = _spots(first[split], count[split])
                own = mix64(_window_keys(grams, window) ^ _WINDOW)
                anchor = np.concatenate([anchor[keep], own])
                first, owner = np.concatenate([first[keep], window]), np.concatenate([owner[keep], np.repeat(owner[split], count[split])])
                length = np.concatenate([count[keep], np.ones(window.size, np.int64)]) + LENGTH - 1
                order, new = _collapse(_content_keys(grams, first, length, anchor), ids[owner], first, data, first, length)
                if not order.size:
                    continue
                group = np.cumsum(new) - 1
                least = ids[owner[order[new]]]
                later = ids[owner[order]] > least[group]
                gone = order[later]
                known = pa.array([_pack(first[gone], first[gone] + length[gone])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number % plan.lanes], pa.int32()), pa.array([number], pa.int64()), known], ["lane", "batch", "blob"])
                heads, rows = order[new], order[~later]
                times = np.bincount(group[~later], minlength=len(heads))
                size = length[heads]
                found = Columns(
                    [anchor[heads], ids[owner[heads]], np.full(len(heads), number, np.int64), size.astype(np.uint8), times.astype(np.uint32)],
                    [data[_spots(first[heads], size)], first[rows].astype(np.uint32)],
                    SEGMENTS[2],
                )
                lane = _part(anchor[heads], plan.lanes)
                ranked = np.argsort(lane, kind="stable")
                for k, a, b in _present(lane[ranked]):
                    sender.add(k, number, found.take(ranked[a:b]))
                yield from sender.end_batch()
        yield from sender.end_batch(last=True)

    # Bits, and what an entry and a row take beside them.
    size = flags.select(F.explode("flags").alias("f")).agg(F.coalesce(F.sum(F.length("f.shared") + F.length("f.hot") + 64), F.lit(0))).first()[0]
    flags = F.broadcast(flags) if size <= BROADCAST_BYTES else flags.hint("merge")
    return packed.join(flags, "batch", "left").select("batch", "blob", "flags").mapInArrow(run, "lane int, batch long, blob binary")


def _window_keys(grams: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH bytes from each position, from the grams that cover them."""
    key = np.zeros(window.size, np.uint64)
    for k in (*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grams[window + k])
    return key


def _content_keys(grams: np.ndarray, first: np.ndarray, length: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """64-bit key of each segment's bytes, from the hashes of grams that together cover it."""
    key = mix64(anchor ^ length.astype(np.uint64))
    if not first.size:
        return key
    last = first + length - GRAM
    for k in range(0, int(length.max()) - GRAM + 1, GRAM):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grams[np.minimum(first + k, last)])
    return mix64(key * np.uint64(0x9E3779B97F4A7C15) + grams[last])


def repeated_windows(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of every window of the segments that also lies in a segment of a smaller id.

    Suffixes of all segments are sorted; windows between which no common prefix is below
    LENGTH are equal.
    """
    n = len(sizes)
    ends = np.cumsum(sizes)
    text = np.ones(int(ends[-1]) + n + 1, np.uint16)  # 1 ends a segment, 0 the text
    text[-1] = 0
    owner = np.repeat(np.arange(n), sizes)
    text[np.arange(owner.size) + owner] = data.astype(np.uint16) + 2
    begin = ends - sizes + np.arange(n)
    # Where a window may start, and the segment of each position.
    segment = np.repeat(np.arange(n), sizes + 1)
    last = begin + sizes - LENGTH
    found_segment, found_window = [], []

    def close(run: np.ndarray, new: np.ndarray) -> None:
        """Of each group of equal windows, those of greater ids than its least."""
        if not len(run):
            return
        starts = np.flatnonzero(new)
        who = ids[segment[run]]
        least = np.repeat(np.minimum.reduceat(who, starts), np.diff(np.append(starts, len(run))))
        bad = run[who > least]
        found_segment.append(segment[bad])
        found_window.append(bad - begin[segment[bad]])

    tail, carry = np.zeros(0, np.int64), LENGTH  # the group that is open; least common prefix since its last window
    for positions, common in suffix_blocks(text, LENGTH, store):
        starts = positions < len(segment)
        starts[starts] = positions[starts] <= last[segment[positions[starts]]]
        at = np.flatnonzero(starts)
        if not len(at):
            carry = min(carry, int(common.min()))
            continue
        shared = np.minimum.reduceat(common[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
        shared[0] = min(int(shared[0]), carry)
        carry = int(common[at[-1] + 1 :].min(initial=LENGTH))
        run = np.concatenate([tail, positions[at]])
        new = np.concatenate([np.zeros(len(tail), bool), shared < LENGTH])
        new[0] = True
        cut = int(np.flatnonzero(new)[-1])  # the last group may go on in the next block
        close(run[:cut], new[:cut])
        tail = run[cut:]
    close(tail, np.arange(len(tail)) == 0)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(found_segment), join(found_window)


def _candidates(grams: np.ndarray, first: np.ndarray, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, low, high): the parts of segments that hold all windows whose hash occurs under several ids.

    Equal windows have equal hashes, so what is left out cannot repeat; what is left is still sorted.
    """
    n = size - LENGTH + 1
    key = _window_keys(grams, _spots(first, n))
    segment = np.repeat(np.arange(len(n)), n)
    order = np.argsort(key)
    key, who = key[order], ids[segment[order]]
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    several = np.minimum.reduceat(who, starts) != np.maximum.reduceat(who, starts)
    at = np.sort(order[np.repeat(several, np.diff(np.append(starts, key.size)))])
    of, window = segment[at], at - (np.cumsum(n) - n)[segment[at]]
    opens = np.ones(of.size, bool)
    opens[1:] = of[1:] != of[:-1]
    heads = np.flatnonzero(opens)
    return of[heads], window[heads], window[np.append(heads[1:], of.size) - 1] + LENGTH if of.size else window


def _search_cell(cell: Columns, store: Store) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(batch, low, high): ranges to remove from the rows of all segments of one cell."""
    anchor, who, batch, size, times = cell.fixed
    data, start = cell.ragged
    size, times = size.astype(np.int64), times.astype(np.int64)
    row, start = np.repeat(np.arange(len(who)), times), start.astype(np.int64)
    of = batch[row]
    first = np.cumsum(size) - size
    grams = _grams(data)
    order, new = _collapse(_content_keys(grams, first, size, anchor), who, first, data, first, size)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    heads = order[new]  # smallest id of each distinct segment
    least = who[heads]
    whole = who[row] > least[group[row]]  # rows whose segment a smaller id has too
    # Anchors with several distinct segments: only their windows can be equal in parts.
    by_anchor = np.argsort(anchor[heads], kind="stable")
    ordered = anchor[heads][by_anchor]
    mixed = np.zeros(len(heads) + 1, bool)
    mixed[1:-1] = ordered[1:] == ordered[:-1]
    varied = np.sort(by_anchor[mixed[:-1] | mixed[1:]])
    lows, highs, owners = [start[whole]], [start[whole] + size[row[whole]]], [of[whole]]
    if varied.size:
        chosen = heads[varied]
        segment, low, high = _candidates(grams, first[chosen], size[chosen], who[chosen])
        varied, chosen = varied[segment], chosen[segment]
        segment, window = repeated_windows(data[_spots(first[chosen] + low, high - low)], high - low, who[chosen], store) if varied.size else (segment, segment)
        window = window + low[segment]
        if segment.size:
            pick = np.lexsort((window, segment))
            segment, window = segment[pick], window[pick]
            new = np.ones(len(segment), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (window[1:] > window[:-1] + LENGTH)
            opening = np.flatnonzero(new)
            closing = np.append(opening[1:], len(segment)) - 1
            group_id, low, high = varied[segment[opening]], window[opening], window[closing] + LENGTH
            # Every remaining row of such a segment loses the same ranges.
            rest = np.flatnonzero(~whole)
            row_group = group[row[rest]]
            by = np.argsort(row_group, kind="stable")
            p, q = np.searchsorted(row_group[by], group_id, "left"), np.searchsorted(row_group[by], group_id, "right")
            which = np.repeat(np.arange(len(group_id)), q - p)
            hit = rest[by[_spots(p, q - p)]]
            lows.append(start[hit] + low[which])
            highs.append(start[hit] + high[which])
            owners.append(of[hit])
    return np.concatenate(owners), np.concatenate(lows), np.concatenate(highs)


def _ranges(segments: DataFrame, plan: Plan, spilled: Accumulator | None) -> DataFrame:
    """batch, ranges: packed ranges to remove; a batch may have several rows."""

    def by_batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        batch, low, high = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(batch, kind="stable")
        batch, low, high = batch[order], low[order], high[order]
        out = [(k, _pack(low[a:b], high[a:b])) for k, a, b in _present(batch)]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([r for _, r in out], pa.binary())], ["batch", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool, sorted_bytes = Spool(SEGMENTS, plan.cells, plan.spool), 0
        for rows in batches:
            known = rows.filter(pc.is_valid(rows.column("batch")))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column("batch"), known.column("blob")], ["batch", "ranges"])
            for number, blob in zip(rows.column("batch").to_pylist(), rows.column("blob").to_pylist()):
                if number is None:
                    spool.add(_received(blob, SEGMENTS)[2])
        found, held = [], 0
        for cell in spool:
            store = Store(plan.sort)
            found.append(_search_cell(cell, store))
            sorted_bytes += store.end
            held += sum(x.nbytes for x in found[-1])
            if held > plan.spool:
                yield by_batch(found)
                found, held = [], 0
        if found:
            yield by_batch(found)
        if spilled is not None:
            spilled.add(spool.end + sorted_bytes)

    return segments.repartitionById(plan.lanes, "lane").mapInArrow(run, "batch long, ranges binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spilled: Accumulator | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of every row.

    ``spilled``, if given, counts the bytes that tasks keep in files.
    """
    packed = materialize(pack_documents(docs, id_col, text_col), "packed")
    total = packed.agg(F.sum("size")).first()[0] or 0
    plan = Plan(total, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    flags = materialize(_shared_anchors(packed, plan, spilled), "anchor-flags", narrow=True)
    found = _ranges(_shared_segments(packed, flags, plan), plan, spilled)
    ranges = found.groupBy("batch").agg(F.collect_list("ranges").alias("ranges"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, found in zip(batch.column("blob").to_pylist(), batch.column("ranges").to_pylist()):
                ids, null, offsets, data = _open(blob)
                change = np.zeros(data.size + 1, np.int32)
                for part in found or []:
                    low, high = _unpack(part, "<i8", "<i8")
                    np.add.at(change, low, 1)
                    np.add.at(change, high, -1)
                gone = np.cumsum(change[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                heads = offsets[:-1][np.diff(offsets) > 0]
                opens[heads] = gone[heads]
                count = np.concatenate([[0], np.cumsum(gone)])
                spans = np.concatenate([[0], np.cumsum(opens)])
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                for a, b in steps(np.diff(offsets), 1 << 22):
                    x, y = offsets[a:b], offsets[a + 1 : b + 1]
                    columns = [pa.array(ids[a:b], pa.int64(), mask=null[a:b]), pa.array(y - x), pa.array(count[y] - count[x]), pa.array(spans[y] - spans[x]), pa.array(kept[a:b], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return packed.join(ranges, "batch", "left").select("blob", "ranges").mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
