"""Media columns: documents kept as PNG images in binary columns.

The UTF-8 bytes of a text, padded with 255 to whole rows, are the 8-bit grey samples of
a PNG: signature, IHDR, IDAT through zlib, IEND, each chunk with its CRC-32. Each row is
stored under the filter (None, Sub, Up, Average, Paeth) with the least sum of absolute
differences. Reading tests every checksum and undoes the filters with numpy: all rows of all
images of a batch go together, a row one step behind the row above it, so a step has every
neighbour that a filter needs. The feature is a low-frequency cosine-transform hash.

Defined results: null and empty texts give one unit of padding; equal texts, and so repeated
rows, give equal values; the first of filters that tie is used; whole texts are stored, however
long; a null doc_id is kept; an empty table gives no rows; other columns may have any name; a
damaged file raises ``ValueError`` in ``read_png`` and gives a null image and an error text in
``decode_column``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sub_batches, text_rows, utf8_buffers

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of one image row, and so the unit of padding.
WIDTH = 576
#: Rows of an image that are unfiltered side by side.
BAND = 32
#: Compressed bytes in one IDAT chunk at most.
IDAT_BYTES = 1 << 20
#: Channels of each colour type.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
#: Side of the reduced image, and of the kept block of low frequencies.
SIDE, LOW = 32, 8


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def _neighbours(image: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples to the left, above, and above to the left of each; ``first``: rows without one above."""
    left, above, corner = (np.zeros(image.shape, np.int16) for _ in range(3))
    left[:, 1:] = image[:, :-1]
    above[1:] = image[:-1]
    above[first] = 0
    corner[:, 1:] = above[:, :-1]
    return left, above, corner


def _paeth(left: np.ndarray, above: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Of three neighbours the one nearest to left + above - corner; ties in this order."""
    a, b, c = np.abs(above - corner), np.abs(left - corner), np.abs(left + above - 2 * corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))


def filtered(rows: np.ndarray, first: np.ndarray, row_filter: int | None = None) -> np.ndarray:
    """Grey rows with their filter byte in front; ``first`` lists the top rows of the images.

    Without ``row_filter`` each row takes the filter with the least sum of absolute differences.
    """
    kinds = np.full(len(rows), row_filter or 0, np.uint8)
    best = np.full(len(rows), np.iinfo(np.int64).max)
    out = np.empty((len(rows), rows.shape[1] + 1), np.uint8)
    near = left, above, corner = _neighbours(rows, first)
    guesses = (lambda: 0, lambda: left, lambda: above, lambda: (left + above) >> 1, lambda: _paeth(*near))
    for kind in range(5) if row_filter is None else (row_filter,):
        difference = (rows - guesses[kind]()).astype(np.uint8)
        cost = np.abs(difference.view(np.int8).astype(np.int16)).sum(axis=1, dtype=np.int64)
        better = cost < best
        best[better], kinds[better] = cost[better], kind
        out[better, 1:] = difference[better]
    out[:, 0] = kinds
    return out


def _png(width: int, height: int, raw: bytes, level: int) -> bytes:
    packed = zlib.compress(raw, level)
    body = b"".join(_chunk(b"IDAT", packed[i : i + IDAT_BYTES]) for i in range(0, len(packed), IDAT_BYTES))
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + body + _chunk(b"IEND", b"")


def write_png(image: np.ndarray, level: int = 3, row_filter: int | None = None) -> bytes:
    """An 8-bit grey PNG of a height x width array; every row under ``row_filter``, or its best filter."""
    height, width = image.shape
    return _png(width, height, filtered(image, np.array([0]), row_filter).tobytes(), level)


def unfiltered(raw: np.ndarray, heights: np.ndarray, step: int) -> np.ndarray:
    """Samples of the filtered rows of several images of one width, end to end; ``step``: bytes of a pixel.

    Images go in bands of BAND rows. In a band row y handles pixel x at step x + y, when the
    row above has just handled it; so a step is one operation over all rows of all images.
    """
    kinds, width = raw[:, 0], (raw.shape[1] - 1) // step
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown row filter")
    values = raw[:, 1:].reshape(len(raw), width, step)
    out = np.empty_like(values)
    tops = np.cumsum(heights) - heights
    for begin in range(0, int(heights.max(initial=0)), BAND):
        counts = np.clip(heights - begin, 0, BAND)
        used = np.flatnonzero(counts)
        counts = counts[used]
        places = np.cumsum(counts) - counts
        nth = np.arange(int(counts.sum())) - np.repeat(places, counts)
        rows = np.repeat(tops[used] + begin, counts) + nth
        kind = kinds[rows][:, None]
        masks = [kind == k for k in range(1, 5)]
        # The row above the band, delayed like the others: pixel x is needed at step x.
        lid = out[tops[used] + begin - 1].astype(np.int16) if begin else np.zeros((len(used), width, step), np.int16)
        span = width + int(counts.max()) - 1
        slanted = np.zeros((span, len(rows), step), np.int16)
        done = np.zeros((span, len(rows), step), np.int16)
        for y in range(int(counts.max())):
            at = np.flatnonzero(nth == y)
            slanted[y : y + width, at] = values[rows[at]].transpose(1, 0, 2)
        zero = np.zeros((len(rows), step), np.int16)
        last, before_last = zero, zero
        for s in range(span):
            above, corner = np.empty_like(zero), np.empty_like(zero)
            above[1:], corner[1:] = last[:-1], before_last[:-1]
            above[places] = lid[:, s] if s < width else 0
            corner[places] = lid[:, s - 1] if 0 < s <= width else 0
            now = slanted[s]
            now = now + np.where(masks[0], last, 0) + np.where(masks[1], above, 0)
            if masks[2].any():
                now += np.where(masks[2], (last + above) >> 1, 0)
            if masks[3].any():
                now += np.where(masks[3], _paeth(last, above, corner), 0)
            now &= 255
            now[(nth > s) | (nth + width <= s)] = 0  # rows that have not begun, or have ended
            done[s], before_last, last = now, last, now
        for y in range(int(counts.max())):
            at = np.flatnonzero(nth == y)
            out[rows[at]] = done[y : y + width, at].transpose(1, 0, 2)
    return out.reshape(len(raw), width * step)


def _opened(data: bytes) -> tuple[int, int, int, np.ndarray]:
    """(height, width, bytes of a pixel, filtered rows) of an 8-bit PNG that is not interlaced."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, header, packed, ended = 8, None, [], False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("a chunk is cut off")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(data):
            raise ValueError("a chunk is cut off")
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if header is None or not ended:
        raise ValueError("IHDR or IEND is missing")
    width, height, depth, colour, _, _, interlace = header
    if depth != 8 or interlace or colour not in CHANNELS:
        raise ValueError("only 8-bit samples without interlace")
    step = CHANNELS[colour]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    except zlib.error as error:
        raise ValueError(str(error)) from error
    if raw.size != height * (width * step + 1):
        raise ValueError("wrong number of samples")
    return height, width, step, raw.reshape(height, width * step + 1)


def read_png(data: bytes) -> np.ndarray:
    """Samples (height x width, or height x width x channels) of an 8-bit PNG that is not interlaced."""
    height, width, step, raw = _opened(data)
    samples = unfiltered(raw, np.array([height]), step)
    return samples if step == 1 else samples.reshape(height, width, step)


def read_pngs(files: list[bytes | None]) -> list[np.ndarray | ValueError]:
    """Samples of each file, or its error; files of one width are unfiltered together."""
    out: list[np.ndarray | ValueError] = []
    groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for i, data in enumerate(files):
        try:
            height, width, step, raw = _opened(data or b"")
            if raw.size and raw[:, 0].max() > 4:
                raise ValueError("unknown row filter")
            groups.setdefault((width, step), []).append((i, raw))
            out.append(np.empty((height, width) if step == 1 else (height, width, step), np.uint8))
        except ValueError as error:
            out.append(error)
    for (_, step), parts in groups.items():
        heights = np.array([len(raw) for _, raw in parts])
        samples = unfiltered(np.concatenate([raw for _, raw in parts]), heights, step)
        for (i, _), end, height in zip(parts, np.cumsum(heights).tolist(), heights.tolist()):
            out[i] = samples[end - height : end].reshape(out[i].shape)
    return out


@lru_cache(maxsize=1)
def _cosines() -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(SIDE)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * SIDE))


def _reduced(image: np.ndarray) -> np.ndarray:
    """Area means on a SIDE x SIDE grid; an axis shorter than that repeats its samples."""
    grey = image.astype(np.float64) if image.ndim == 2 else image[..., : max(1, image.shape[2] - (image.shape[2] in (2, 4)))].mean(axis=2)
    for axis in (0, 1):
        n = grey.shape[axis]
        if n < SIDE:
            grey = np.take(grey, np.arange(SIDE) * n // SIDE, axis=axis)
        else:
            cuts = np.arange(SIDE + 1) * n // SIDE
            sums = np.add.reduceat(grey, cuts[:-1], axis=axis)
            shape = [1, 1]
            shape[axis] = SIDE
            grey = sums / np.diff(cuts).reshape(shape)
    return grey


def cosine_hash(image: np.ndarray) -> str:
    """16 hex digits: signs of the low cosine frequencies against their median."""
    c = _cosines()
    low = np.round(c @ _reduced(image) @ c.T, 6)
    bits = (low > np.median(low.ravel()[1:])).ravel()
    return np.packbits(bits).tobytes().hex()


def encode_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 3) -> DataFrame:
    """doc_id, n_bytes (of the text) and ``media``, its PNG."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            data, offsets = utf8_buffers(batch.column("text"))
            sizes = np.diff(offsets)
            heights = np.maximum(1, -(-sizes // WIDTH))
            ends = np.cumsum(heights)
            samples = np.full(int(ends[-1]) * WIDTH, 255, np.uint8)
            shift = np.repeat((ends - heights) * WIDTH - offsets[:-1], sizes)
            samples[np.arange(data.size) + shift] = data
            rows = filtered(samples.reshape(-1, WIDTH), ends - heights)
            files = [_png(WIDTH, h, rows[e - h : e].tobytes(), level) for e, h in zip(ends.tolist(), heights.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decode_column(media: DataFrame) -> DataFrame:
    """``media``'s rows with the samples read back (``payload``), their ``feature``, and ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "media"):
            out = [(None, None, str(x)) if isinstance(x, ValueError) else (x.tobytes(), cosine_hash(x), None) for x in read_pngs(batch.column("media").to_pylist())]
            extra = [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "payload", "feature", "error"])

    return media.mapInArrow(run, ", ".join(f"`{k}` {v}" for k, v in media.dtypes) + ", payload binary, feature string, error string")


def digests(docs: DataFrame) -> DataFrame:
    """The media columns of every document, read back from their stored form."""
    stored = decode_column(encode_column(docs))
    return stored.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, length(payload) - 31, 32)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
