"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs without regular expressions. Each code point has a class; each
class is a function from scanner state to scanner state. These functions are closed
under composition (a finite monoid), so the state at every position of a whole batch
is a prefix scan with an associative operator, done as table look-ups on numpy arrays:
first along short columns of many blocks at once, then over the block totals by
doubling. Boundaries are read off neighbouring states. The slices between them go
through a bounded cache of merged pieces, and each token keeps its byte offset, by
which decoding is one gather from the vocabulary's bytes.

Defined results: a null or empty text has no tokens and decodes to no bytes; very long
texts are encoded whole; of merges with one rank the leftmost goes first; rows keep their order
and repeated rows give repeated results; a null doc_id is kept; an empty table gives no rows;
columns other than doc_id and text may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import sub_batches, text_rows

# Symbols: what the scanner sees of a code point.
RESET, SPACE, WHITE, APOS, OTHER, NUMBER, LETTER, L_S, L_T, L_M, L_D, L_R, L_V, L_L, L_E = range(15)
# States: what the code point just read is part of.
BEGIN, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WHITE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CONTRACTION = range(11)
N_STATES = 11

#: The white space of the pattern's \s (the Unicode property White_Space).
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Letters and numbers of Unicode 16 that Python's Unicode 15.1 data lacks.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

#: Pieces that the cache of one worker holds before it starts anew.
CACHE_PIECES = 150_000
#: Tokens that are decoded at once for a digest.
DECODE_TOKENS = 1 << 16


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Symbol of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for ranges, symbol in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            table[first : last + 1] = symbol
    table[WHITE_SPACE] = WHITE
    table[0x20] = SPACE
    table[ord("'")] = APOS
    for char, symbol in zip("stmdrvle", (L_S, L_T, L_M, L_D, L_R, L_V, L_L, L_E)):
        table[ord(char)] = symbol
    return table


def step(state: int, symbol: int) -> int:
    """The scanner's state after one more code point."""
    if symbol == RESET:
        return BEGIN
    if symbol == SPACE:
        return S_SPACE
    if symbol == WHITE:
        return S_WHITE
    if symbol == NUMBER:
        return S_NUMBER
    if symbol == OTHER:
        return S_OTHER
    if symbol == APOS:  # it opens a token unless a space or other signs hold it
        return S_OTHER if state in (S_OTHER, S_SPACE, QUOTE) else QUOTE
    if state == QUOTE:
        if symbol in (L_S, L_T, L_M, L_D):
            return CONTRACTION
        return {L_R: QUOTE_R, L_V: QUOTE_V, L_L: QUOTE_L}.get(symbol, S_LETTER)
    if (state, symbol) in ((QUOTE_R, L_E), (QUOTE_V, L_E), (QUOTE_L, L_L)):
        return CONTRACTION
    return S_LETTER


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions.

    Returns (element of each symbol, composition table, function of each element as the
    states it leads to). ``table[a, b]`` is "first a, then b".
    """
    basic = [tuple(step(s, symbol) for s in range(N_STATES)) for symbol in range(15)]
    ids = {tuple(range(N_STATES)): 0}
    todo = list(ids)
    while todo:
        f = todo.pop()
        for g in basic:
            h = tuple(g[x] for x in f)
            if h not in ids:
                ids[h] = len(ids)
                todo.append(h)
    functions = np.array(list(ids), np.uint8)
    width = len(ids)
    table = np.zeros((width, width), np.uint16)
    for a in range(width):
        for b, g in enumerate(functions):
            table[a, b] = ids[tuple(g[functions[a]].tolist())]
    return np.array([ids[f] for f in basic], np.uint16), table, functions


def scan_states(symbols: np.ndarray, block: int = 256) -> np.ndarray:
    """Scanner state after each symbol: an associative prefix scan."""
    of_symbol, table, functions = monoid()
    n = len(symbols)
    width = len(table)
    rows = -(-n // block)
    elements = np.zeros(rows * block, np.uint16)
    elements[:n] = of_symbol[symbols]
    # Columns are the inner axis, so each step below is one look-up over contiguous memory.
    columns = np.ascontiguousarray(elements.reshape(rows, block).T)
    flat = table.ravel()
    for i in range(1, block):
        columns[i] = flat[columns[i - 1].astype(np.int32) * width + columns[i]]
    totals = columns[-1].copy()
    shift = 1
    while shift < rows:
        totals[shift:] = flat[totals[:-shift].astype(np.int32) * width + totals[shift:]]
        shift *= 2
    before = np.zeros(rows, np.uint16)
    before[1:] = totals[:-1]
    start_state = functions[before, BEGIN]
    # Apply each block's functions to the state in which the block begins.
    states = functions.ravel()[columns.astype(np.int32) * N_STATES + start_state[None, :]]
    return np.ascontiguousarray(states.T).ravel()[:n]


def piece_starts(symbols: np.ndarray) -> np.ndarray:
    """True where a piece begins; every text in ``symbols`` is followed by one RESET."""
    states = scan_states(symbols)
    n = len(states)
    before = np.empty(n, np.uint8)
    before[0] = BEGIN
    before[1:] = states[:-1]
    after = np.empty(n, np.uint8)
    after[-1] = BEGIN
    after[:-1] = states[1:]
    # Kind of piece a state belongs to, to see where the kind changes.
    kind = np.array([0, 1, 2, 3, 4, 5, 3, 1, 1, 1, 6], np.uint8)
    white = np.array([0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0], bool)
    open_quote = np.array([0, 0, 0, 0, 0, 0, 0, 1, 1, 1, 0], bool)
    starts = kind[states] != kind[before]
    starts |= before == CONTRACTION
    # A space joins what follows it; another white character does not.
    starts &= ~((before == S_SPACE) & ~white[states])
    # White runs are one piece but for their last character, if a text goes on behind it.
    in_white = white[states] & white[before]
    starts[in_white] = (~white[after] & (after != BEGIN))[in_white]
    # 's 't 'm 'd 're 've 'll stay whole.
    starts[(states == CONTRACTION)] = False
    starts[open_quote[states] & (after == CONTRACTION)] = False
    starts[symbols == RESET] = True
    return starts


class Vocabulary:
    """Ranks of byte strings; encodes pieces by merging and decodes by one gather."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the adjacent pair of lowest rank merges first, leftmost on ties."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if n <= 48:
            return self._merge_short(piece)
        ends = list(range(1, n + 1))  # end of the part that begins at i; 0 once it is merged away
        previous = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = self.ranks.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or ends[middle] != end:  # one of the two parts has changed
                continue
            ends[i], ends[middle] = end, 0
            if end < n:
                previous[end] = i
                rank = self.ranks.get(piece[i : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            left = previous[i]
            if left >= 0:
                rank = self.ranks.get(piece[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : ends[i]]])
            i = ends[i]
        return ids

    def _merge_short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, 1 << 40
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _miss(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), "<u4").tobytes()
        if len(self.cache) >= CACHE_PIECES:
            self.cache.clear()
        if len(piece) <= 256:
            self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        joined = "\x00".join([t or "" for t in texts]) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        raw = joined.encode()
        symbols = class_table()[points]
        lengths = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        symbols[ends] = RESET
        starts = np.flatnonzero(piece_starts(symbols))
        if len(raw) != len(points):
            widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            at = np.cumsum(widths) - widths
            byte_starts = at[starts]
        else:
            byte_starts = starts
        where = np.searchsorted(starts, ends)
        cuts = byte_starts.tolist()
        out, first, get, miss = [], 0, self.cache.get, self._miss
        for last in where.tolist():
            span = cuts[first : last + 1]
            pieces = [raw[a:b] for a, b in zip(span, span[1:])]
            out.append(b"".join([get(p) or miss(p) for p in pieces]))
            first = last + 1
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token begins, and the end of the last."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bytes of the tokens: a gather by the retained offsets."""
        shift = self.first[ids] - offsets[:-1]
        return self.bytes[np.arange(offsets[-1]) + np.repeat(shift, np.diff(offsets))]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = True) -> DataFrame:
    """Per row: doc_id, ids (little-endian u32), token_ends (little-endian u32 byte offsets).

    ``ranks_path`` must be readable on every executor. ``offsets=False`` leaves the
    offsets out; ``decode_documents`` then derives them from the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in sub_batches(batches, "text"):
            ids = vocab.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary())]
            if offsets:
                columns.append(pa.array([vocab.offsets(np.frombuffer(x, "<u4"))[1:].astype("<u4").tobytes() for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "token_ends"][: len(columns)])

    schema = "doc_id long, ids binary" + ", token_ends binary" * offsets
    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encode_documents`` with ``decoded``, the bytes of all their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in sub_batches(batches, "ids"):
            out = []
            for i, raw in enumerate(batch.column("ids").to_pylist()):
                ids = np.frombuffer(raw or b"", "<u4")
                if "token_ends" in batch.schema.names:
                    ends = np.frombuffer(batch.column("token_ends")[i].as_py() or b"", "<u4").astype(np.int64)
                    out.append(vocab.decode(ids, np.concatenate([[0], ends])).tobytes())
                else:
                    out.append(vocab.decode(ids, vocab.offsets(ids)).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in encoded.dtypes) + ", decoded binary")


def digests(docs: DataFrame, ranks_path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, with ``ids`` the ids (little-endian u32), ids_sha256, decoded_sha256 of every document.

    A row is encoded and decoded in one pass, so a task has one Python worker with one
    vocabulary, and decoded bytes, ``DECODE_TOKENS`` at a time, do not leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in sub_batches(batches, "text"):
            coded = vocab.encode(batch.column("text").to_pylist())
            decoded = []
            for raw in coded:
                tokens, digest = np.frombuffer(raw, "<u4"), hashlib.sha256()
                for at in range(0, len(tokens), DECODE_TOKENS):
                    part = tokens[at : at + DECODE_TOKENS]
                    digest.update(vocab.decode(part, vocab.offsets(part)))
                decoded.append(digest.hexdigest())
            columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in coded], pa.int64())]
            if ids:
                columns.append(pa.array(coded, pa.binary()))
            columns += [pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", *["ids"] * ids, "ids_sha256", "decoded_sha256"]
    schema = "doc_id long, n_tokens long, " + "ids binary, " * ids + "ids_sha256 string, decoded_sha256 string"
    return text_rows(docs).mapInArrow(run, schema)
