"""Benchmark decontamination by templates.

Texts become templates: numbers, units behind numbers, and names (capitalised words
inside a sentence; neighbours count as one) are replaced by typed placeholders, words
are lower-cased, and the replaced values are kept as slots. Windows of ``WINDOW`` template
tokens of the documents are hash-joined with those of the benchmark. Per document, item and
alignment the slots must be consistent: a value of the item always stands against the
same value of the document, though it may be another one. An item leaks into a document
whose consistent alignments hold at least ``CONTAINMENT`` of the item's windows, so a
question with changed numbers or names is caught like a copy.

As names are told by their capitals, a copy in upper case, Title Case or lower case has other
templates. So windows are made a second time from the case-folded text, where names are
words, and an item leaks if its windows of either kind reach ``CONTAINMENT``.

An item that leaks shares one of its rarer windows with the document (a prefix filter, exact), so windows
that many items have in common make no pairs.

The benchmark's distinct windows are counted first: up to ``BROADCAST_WINDOWS`` they are
broadcast to drop other windows where the documents are read; beyond that all windows go
to the same join.

Windows need ``PLAIN`` words that are no placeholders. Items without such a window (dense in
slots, or shorter) are matched as a whole run: the hash of all their template tokens is joined
with the runs of as many template tokens of the documents, and the slots must be consistent. Such
a run needs ``DENSE_TOKENS`` tokens of which ``DENSE_PLAIN`` are plain words, as little else
tells it from chance. An item's first word may be a name that only its place at the head of a
sentence hides, so items of up to ``SHORT`` tokens are matched as a whole run a second time with
capitals at such places as names, against runs of both readings of the documents and of their case-folded text. Whatever its
words, an item without a window is also matched exactly by its case-folded raw tokens. Items of
numbers alone leak only into documents that consist of the same numbers. Documents are searched
for the first ``WINDOW`` tokens of a run before the whole run is hashed.

Defined results: null and empty texts are never contaminated and null items never leak;
an item_id with several texts leaks if any of them does;
repeated rows of a doc_id count as one document; rows with a null doc_id are not reported;
several alignments of one item count together, each window once; whole texts are searched,
however long; without documents or items nothing is reported; columns other than doc_id, item_id
and text may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix64, opened_rows, packed_rows, random_table, sub_batches, text_rows, utf8_buffers

WINDOW, PLAIN = 5, 3
CONTAINMENT = 0.35
#: Tokens and plain words of an item that is matched as a whole run, and tokens of one whose first word is also tried as a name.
DENSE_TOKENS, DENSE_PLAIN, SHORT = 4, 2, 8
#: Share of an alignment's slot values that may be inconsistent.
INCONSISTENT = 0.2
#: Tasks that share the documents of one window.
SALTS = 8
#: Distinct benchmark windows (8 bytes each) that are broadcast at most.
BROADCAST_WINDOWS = 1 << 20

WORD, NUMBER, UNIT, NAME = range(4)
#: Units that count as such behind a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent degrees kmh mph w kw v a hz khz mhz ghz kb mb gb tb"
).split()

_BYTES = random_table(256, 21)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BASE = random_table(1, 22)[0] | np.uint64(1)
_PLACES = random_table(WINDOW, 23) | np.uint64(1)
_SLOTS = random_table(4, 24)
_STRIDE, _RUN = random_table(2, 25) | np.uint64(1)
#: Windows of the two kinds do not meet.
_FOLDED = random_table(1, 26)[0]
#: Nor do runs of templates, of raw tokens, and whole texts of numbers.
_DENSE, _NUMBERS = random_table(2, 27)
_BACK = np.uint64(pow(int(_STRIDE), -1, 1 << 64))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _text_hashes(words: list[str]) -> np.ndarray:
    raw = [np.frombuffer(w.encode(), np.uint8) for w in words]
    return mix64(np.array([(_BYTES[r] * _powers(r.size)).sum() + np.uint64(r.size) for r in raw], np.uint64))


_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\n\r")] = True


@lru_cache(maxsize=1)
def _capitals() -> np.ndarray:
    """Whether each code point of the first plane is a capital letter, of whatever script."""
    return np.array([chr(c).isupper() or chr(c).istitle() for c in range(0x10000)])


_UNIT_HASHES = _text_hashes(UNITS)


class Templates:
    """Template tokens of many texts: ``value`` (placeholder or word), ``raw`` value, ``kind``, and n + 1 offsets.

    Without ``names`` capitalised words are words, and every token is one of its own; with
    ``heads`` they are names at the head of a sentence too.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, names: bool = True, heads: bool = False):
        n = data.size
        digit, letter = _DIGIT[data], _LETTER[data]
        # A point or comma between two digits belongs to the number.
        joint = np.zeros(n, bool)
        if n > 2:
            joint[1:-1] = ((data[1:-1] == ord(".")) | (data[1:-1] == ord(","))) & digit[:-2] & digit[2:]
        kind = np.where(digit | joint, np.uint8(1), np.where(letter, np.uint8(2), np.uint8(0)))
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[0], kind[:-1]]).astype(np.uint8)
        after = np.concatenate([kind[1:], [0]]).astype(np.uint8)
        starts = np.flatnonzero((kind != 0) & ((before != kind) | edge[:-1]))
        ends = np.flatnonzero((kind != 0) & ((after != kind) | edge[1:])) + 1
        lengths = ends - starts
        if not starts.size:
            self.value = self.raw = np.zeros(0, np.uint64)
            self.kind, self.offsets = np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
            return
        first = np.cumsum(lengths) - lengths
        inside = kind != 0
        place = np.arange(int(inside.sum())) - np.repeat(first, lengths)
        raw = mix64(np.add.reduceat(_BYTES[data[inside]] * _powers(int(lengths.max()))[place], first) + lengths.astype(np.uint64))
        texts = np.searchsorted(starts, offsets)
        opens = np.zeros(starts.size + 1, bool)
        opens[texts] = True  # first token of a text
        opens = opens[:-1]
        stops = np.concatenate([[0], np.cumsum(_STOP[data] & ~joint)])
        previous_end = np.concatenate([[0], ends[:-1]])
        sentence = opens | (stops[starts] > stops[previous_end])
        head = data[starts]
        second = data[np.minimum(starts + 1, n - 1)]
        third = data[np.minimum(starts + 2, n - 1)].astype(np.int64) & 63
        high, middle = head.astype(np.int64), second.astype(np.int64) & 63
        point = np.where(high < 0x80, high, np.where(high < 0xE0, (high & 31) << 6 | middle, (high & 15) << 12 | middle << 6 | third))
        capital = _capitals()[point] & (high < 0xF0)
        token = np.where(digit[starts], np.uint8(NUMBER), np.uint8(WORD))
        if names:
            token[capital & (~sentence | heads) & (token == WORD)] = NAME
        behind = np.concatenate([[False], token[:-1] == NUMBER]) & ~opens
        token[behind & (token != NUMBER) & np.isin(raw, _UNIT_HASHES)] = UNIT
        keep = np.ones(starts.size, bool)
        keep[1:] = ~((token[1:] == NAME) & (token[:-1] == NAME) & ~opens[1:])
        # A name of several words is one slot, whose value mixes all of them.
        run = np.cumsum(keep) - 1
        mixed = np.zeros(int(keep.sum()), np.uint64)
        np.add.at(mixed, run, raw)
        self.raw, self.kind = mixed, token[keep]
        self.value = np.where(self.kind == WORD, self.raw, _SLOTS[self.kind])
        self.offsets = np.concatenate([[0], np.cumsum(keep)])[texts]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, position) of every window of ``size`` tokens with enough plain words."""
        total = np.zeros(self.value.size, np.uint64) + np.uint64(size)
        plain = np.zeros(self.value.size + size, np.int16)
        value = np.concatenate([self.value, np.zeros(size, np.uint64)])
        plain[: self.value.size] = self.kind == WORD
        counts = np.zeros(self.value.size, np.int16)
        for k in range(size):
            total += value[k : k + self.value.size] * _PLACES[k]
            counts += plain[k : k + self.value.size]
        text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
        at = np.arange(self.value.size)
        good = (at + size <= self.offsets[text + 1]) & (counts >= PLAIN)
        return mix64(total[good]), text[good], (at - self.offsets[text])[good]


_WINDOWS = "id long, h long, pos int, n_windows int, slots array<long>"
#: ``length``: tokens of the window or the run; ``anchor``: hash of the first tokens of a run.
_ITEMS = _WINDOWS + ", version long, kind int, length int, anchor long"
#: Runs: of raw tokens, of template tokens in both readings of an item's head, and numbers alone.
NAMED, FOLDED, EXACT, DENSE, HEADED, NUMBERS = range(6)


class Wanted(NamedTuple):
    """Runs that documents are searched for."""

    anchors: tuple[np.ndarray, np.ndarray] | None  # (hash of the first tokens, length), sorted by hash; None if too many
    lengths: list[int]


class Search:
    """What documents are searched for; ``None`` where it is too much to be broadcast."""

    def __init__(self, sizes: dict[int, list[int]], windows: np.ndarray | None, exact: Wanted, dense: Wanted, numbers: bool):
        self.sizes = sizes  # of the items' windows, by kind
        self.windows = windows  # sorted hashes
        self.exact, self.dense = exact, dense  # runs of raw and of template tokens
        self.numbers = numbers  # whether an item consists of numbers alone


def folded(text: pa.Array) -> Templates:
    """Tokens of case-folded texts, names being words."""
    return Templates(*utf8_buffers(pa.array([t and t.casefold() for t in text.to_pylist()], pa.large_string())), names=False)


class Runs:
    """Hashes of runs of raw tokens, each in constant time."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * _powers(raw.size, _STRIDE)[: raw.size], dtype=np.uint64)])
        self.back = _powers(raw.size, _BACK)

    def __call__(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        inner = (self.sums[begin + length] - self.sums[begin]) * self.back[begin]
        return mix64(inner + length.astype(np.uint64) * _RUN)


def _item_runs(made: Templates, tokens: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, hash of the first tokens, length) of the whole runs of ``chosen`` texts."""
    text = np.flatnonzero(chosen)
    begin, length, runs = made.offsets[:-1][text], np.diff(made.offsets)[text], Runs(tokens)
    return text, runs(begin, length), runs(begin, np.minimum(length, WINDOW)), length


def _count(made: Templates, kinds: np.ndarray) -> np.ndarray:
    """How many tokens of each text ``kinds`` marks."""
    total = np.concatenate([[0], np.cumsum(kinds)])
    return total[made.offsets[1:]] - total[made.offsets[:-1]]


def _dense(made: Templates) -> np.ndarray:
    """Texts that may be matched as a whole run of template tokens."""
    plain = _count(made, made.kind == WORD)
    return (np.diff(made.offsets) >= DENSE_TOKENS) & (plain >= DENSE_PLAIN) & (plain < np.diff(made.offsets))


def _document_runs(made: Templates, tokens: np.ndarray, wanted: Wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, position, length) of the documents' runs that may be a wanted one."""
    text = np.repeat(np.arange(len(made.offsets) - 1), np.diff(made.offsets))
    at, left, runs = np.arange(text.size), made.offsets[text + 1] - np.arange(text.size), Runs(tokens)
    begins, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if wanted.anchors is None:
        for n in wanted.lengths:
            begins.append(at[left >= n])
            lengths.append(np.full(begins[-1].size, n))
    else:
        anchors, sizes = wanted.anchors
        for n in sorted({min(n, WINDOW) for n in wanted.lengths}):
            begin = at[left >= n]
            h = runs(begin, np.full(begin.size, n))
            first = np.searchsorted(anchors, h)
            count = np.searchsorted(anchors, h, "right") - first
            hit = np.flatnonzero(count)
            count = count[hit]
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            begins.append(np.repeat(begin[hit], count))
            lengths.append(sizes[np.repeat(first[hit], count) + nth])
    begin, length = np.concatenate(begins), np.concatenate(lengths)
    fits = length <= left[begin]
    begin, length = begin[fits], length[fits]
    return text[begin], runs(begin, length), begin - made.offsets[text[begin]], length


class Found(NamedTuple):
    """Windows or runs: the row of the text in its batch, hash, position, windows of the text, slots, length."""

    text: np.ndarray
    h: np.ndarray
    at: np.ndarray
    n_windows: np.ndarray
    slots: list[np.ndarray]
    length: np.ndarray

    def rows(self, batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
        columns = {
            "id": batch.column("id").take(pa.array(self.text)),
            "h": pa.array(self.h.view(np.int64)),
            "pos": pa.array(self.at.astype(np.int32)),
            "n_windows": pa.array(self.n_windows.astype(np.int32)),
            "slots": pa.array(self.slots, pa.list_(pa.int64())),
        } | more
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def item_rows(self, batch: pa.RecordBatch, kind: int, anchor: pa.Array | None = None) -> pa.RecordBatch:
        n = self.text.size
        anchor = pa.nulls(n, pa.int64()) if anchor is None else anchor
        version = batch.column("version").take(pa.array(self.text))
        return self.rows(batch, version=version, kind=pa.array(np.full(n, kind, np.int32)), length=pa.array(self.length.astype(np.int32)), anchor=anchor)


def template_windows(made: Templates, kind: int, sizes: list[int], wanted: np.ndarray | None, whole: bool) -> Found:
    """The windows of texts. ``whole``: texts shorter than a window are one window."""
    tokens = np.diff(made.offsets)
    hashes, texts, places, widths = [], [], [], []
    for size in sizes:
        h, text, at = made.windows(size)
        if kind == FOLDED:
            h = h + _FOLDED
        keep = np.ones(len(h), bool)
        if whole and size < WINDOW:
            keep &= tokens[text] == size
        if wanted is not None:
            spot = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            keep &= wanted[spot] == h if len(wanted) else False
        hashes.append(h[keep])
        texts.append(text[keep])
        places.append(at[keep])
        widths.append(np.full(int(keep.sum()), size))
    h, text, at, width = (np.concatenate(x) for x in (hashes, texts, places, widths))
    begin = made.offsets[text] + at
    slots = []
    for b, w in zip(begin.tolist(), width.tolist()):
        used = np.flatnonzero(made.kind[b : b + w] != WORD)
        slots.append(made.raw[b + used].view(np.int64))
    n_windows = np.bincount(text, minlength=len(tokens)) if len(text) else np.zeros(len(tokens), np.int64)
    return Found(text, h, at, n_windows[text], slots, width)


def _slots(made: Templates, begin: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    out = []
    for b, n in zip(begin.tolist(), length.tolist()):
        out.append(made.raw[b + np.flatnonzero(made.kind[b : b + n] != WORD)].view(np.int64))
    return out


def _whole_runs(text: np.ndarray, h: np.ndarray, at: np.ndarray, length: np.ndarray, slots: list[np.ndarray] | None = None) -> Found:
    """Runs as one window each. Without ``slots`` every value is in the hash."""
    return Found(text, h, at, np.ones(text.size), [np.zeros(0, np.int64)] * text.size if slots is None else slots, length)


def _readings(text: pa.Array) -> tuple[Templates, Templates]:
    """Texts with the head of a sentence as a word, and as a name if it has a capital."""
    buffers = utf8_buffers(text)
    return Templates(*buffers), Templates(*buffers, heads=True)


def _item_windows(items: DataFrame) -> DataFrame:
    sizes = list(range(PLAIN, WINDOW + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            open_items = np.ones(batch.num_rows, bool)
            plain = folded(batch.column("text"))
            usual, headed = _readings(batch.column("text"))
            for kind, made in ((NAMED, usual), (FOLDED, plain)):
                found = template_windows(made, kind, sizes, None, whole=True)
                open_items[found.text] = False
                yield found.item_rows(batch, kind)
            letters, tokens = _count(plain, plain.kind != NUMBER), np.diff(plain.offsets)
            text, h, anchor, length = _item_runs(plain, plain.raw, open_items & (letters > 0))
            yield _whole_runs(text, h, np.zeros(text.size), length).item_rows(batch, EXACT, pa.array(anchor.view(np.int64)))
            text, h, _, length = _item_runs(plain, plain.raw, (letters == 0) & (tokens > 0))
            yield _whole_runs(text, h + _NUMBERS, np.zeros(text.size), length).item_rows(batch, NUMBERS)
            moved = _count(headed, headed.kind == NAME) > 0  # else both readings are the same
            for kind, made, chosen in ((DENSE, usual, open_items), (HEADED, headed, moved & (open_items | (tokens <= SHORT)))):
                text, h, anchor, length = _item_runs(made, made.value, chosen & _dense(made))
                slots = _slots(made, made.offsets[text], length)
                yield _whole_runs(text, h + _DENSE, np.zeros(text.size), length, slots).item_rows(batch, kind, pa.array(anchor.view(np.int64)))

    return items.mapInArrow(run, _ITEMS)


def _dense_runs(text: pa.Array, wanted: Wanted) -> Iterator[Found]:
    """Runs of both readings and of case-folded text; those of a later one only where it differs."""
    known: set[tuple[int, int]] = set()
    for nth, made in enumerate((*_readings(text), folded(text))):
        row, h, at, length = _document_runs(made, made.value, wanted)
        if nth:
            fresh = np.array([pair not in known for pair in zip(row.tolist(), h.tolist())], bool)
            row, h, at, length = row[fresh], h[fresh], at[fresh], length[fresh]
        known.update(zip(row.tolist(), h.tolist()))
        # Positions of the readings are not comparable; a run is one window, so each stands alone.
        yield _whole_runs(row, h + _DENSE, at * 3 + nth, length, _slots(made, made.offsets[row] + at, length))


def _windows(table: DataFrame, search: Search) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            asked = shared.value
            if asked.sizes[NAMED]:
                yield template_windows(Templates(*utf8_buffers(batch.column("text"))), NAMED, asked.sizes[NAMED], asked.windows, whole=False).rows(batch)
            if asked.sizes[FOLDED] or asked.exact.lengths or asked.numbers:
                plain = folded(batch.column("text"))
            if asked.sizes[FOLDED]:
                yield template_windows(plain, FOLDED, asked.sizes[FOLDED], asked.windows, whole=False).rows(batch)
            if asked.exact.lengths:
                yield _whole_runs(*_document_runs(plain, plain.raw, asked.exact)).rows(batch)
            if asked.dense.lengths:
                for found in _dense_runs(batch.column("text"), asked.dense):
                    yield found.rows(batch)
            if asked.numbers:
                text, h, _, length = _item_runs(plain, plain.raw, (np.diff(plain.offsets) > 0) & (_count(plain, plain.kind != NUMBER) == 0))
                yield _whole_runs(text, h + _NUMBERS, np.zeros(text.size), length).rows(batch)

    return table.mapInArrow(run, _WINDOWS)


def _wanted(runs: DataFrame) -> Wanted:
    pairs = runs.select("anchor", "length").distinct()
    if pairs.count() > BROADCAST_WINDOWS:
        return Wanted(None, sorted(r["length"] for r in pairs.select("length").distinct().collect()))
    known = pairs.toArrow()
    hashes, sizes = known["anchor"].to_numpy().view(np.uint64), known["length"].to_numpy().astype(np.int64)
    order = np.argsort(hashes)
    return Wanted((hashes[order], sizes[order]), np.unique(sizes).tolist())


def _search(asked: DataFrame) -> Search:
    windows = asked.filter(F.col("kind").isin(NAMED, FOLDED))
    sizes = {NAMED: [], FOLDED: []}
    for r in windows.select("kind", "length").distinct().collect():
        sizes[r["kind"]].append(r["length"])
    distinct = windows.select("h").distinct()
    wanted = np.sort(distinct.toArrow()["h"].to_numpy().view(np.uint64)) if distinct.count() <= BROADCAST_WINDOWS else None
    numbers = not asked.filter(F.col("kind") == NUMBERS).isEmpty()
    return Search(sizes, wanted, _wanted(asked.filter(F.col("kind") == EXACT)), _wanted(asked.filter(F.col("kind").isin(DENSE, HEADED))), numbers)


def leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """Pairs (doc_id, item_id) with ``containment`` and ``same_slots`` (no value was changed)."""
    texts = text_rows(docs).withColumnRenamed("doc_id", "id").filter("id is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter("id is not null")
    asked = _item_windows(items.dropDuplicates(["id", "text"]).withColumn("version", F.xxhash64("text"))).select(
        F.col("id").alias("item_id"), "version", "h", F.col("pos").alias("item_pos"), "n_windows", F.col("slots").alias("item_slots"), "kind", "anchor", "length"
    )
    asked = materialize(asked, "item-windows")
    search = _search(asked)
    found = _windows(texts, search).select(F.col("id").alias("doc_id"), "h", "pos", "slots")
    if search.windows is None or search.exact.anchors is None or search.dense.anchors is None:
        found = found.join(asked.select("h").distinct(), "h", "left_semi")
    found = materialize(found, "found-windows", narrow=True)
    # A leak holds at least a share of the item's windows, so it holds one of its rarer windows: those that many
    # items share bring none together. The rows of one window are dealt over SALTS tasks.
    key = ["item_id", "version", "kind"]
    shared = asked.groupBy("h").agg(F.count("*").alias("n_items"))
    order = Window.partitionBy(*key).orderBy("n_items", "h", "item_pos")
    rare = asked.join(shared, "h").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= F.col("n_windows") - F.ceil(F.col("n_windows") * F.lit(containment) - F.lit(1e-9)) + 1)
    salted = rare.select("h", *key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = found.select("doc_id", "h", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")).join(salted, ["h", "salt"]).select("doc_id", *key).distinct()
    windows = asked.drop("anchor", "length")
    matched = found.join(pairs, "doc_id").join(windows, ["h", *key]).dropDuplicates(["doc_id", "pos", *key, "item_pos"])
    pair = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    aligned = (
        matched.withColumn("diagonal", F.col("pos") - F.col("item_pos"))
        .groupBy("doc_id", "item_id", "version", "kind", "diagonal")
        .agg(F.collect_set("item_pos").alias("places"), F.array_distinct(F.flatten(F.collect_list(pair))).alias("pairs"), F.first("n_windows").alias("n_windows"))
    )
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    consistent = aligned.filter(F.size("pairs") - values <= INCONSISTENT * values)
    same = F.forall("pairs", lambda p: p["item"] == p["doc"])
    covered = (
        consistent.select("doc_id", "item_id", "version", "kind", "n_windows", same.alias("same"), F.explode("places").alias("place"))
        .groupBy("doc_id", "item_id", "version", "kind", "n_windows", "place")
        .agg(F.bool_or("same").alias("same"))
        .groupBy("doc_id", "item_id", "version", "kind", "n_windows")
        .agg(F.count("*").alias("n"), F.bool_and("same").alias("same_slots"))
    )
    share = F.col("n") / F.col("n_windows")
    return (
        covered.filter(share >= containment)
        .groupBy("doc_id", "item_id")
        .agg(F.max(share).alias("containment"), F.bool_and("same_slots").alias("same_slots"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """One row per contaminated document: doc_id, n_items, items (comma-joined, ascending), containment (greatest), reparameterised."""
    return (
        leaks(docs, benchmark, containment)
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("n_items"),
            F.array_join(F.transform(F.array_sort(F.collect_list("item_id")), lambda i: i.cast("string")), ",").alias("items"),
            F.max("containment").alias("containment"),
            F.bool_or(~F.col("same_slots")).alias("reparameterised"),
        )
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; rows with a null doc_id stay."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("gone"))
    rows = packed_rows(docs, F.col("doc_id").cast("long").alias("key")).join(found, F.col("key") == F.col("gone"), "left_anti")
    return opened_rows(rows, docs.columns)
