"""Token ids in binary shard files with a minimal perfect hash index.

A shard file is: header, raw id payload, document keys, id offsets, ordinals, hash index, footer.
The index maps each document key to its place in the shard without storing keys in the
hash: levels of bit arrays (a key sits at the first level where no other key hashes to
its bit), ranks by counting bits from the last stored count, and a stored 32-bit fingerprint
that tells keys of the shard from others. A look-up is constant time and reads only slices of
a few bytes: route to the shard by key range, hash, check bit, fingerprint and key, read the
document's part of the payload.

Documents are range-partitioned and sorted by key, so shards hold ascending runs; ids
are written as they are encoded. Each task attempt writes its own file and only the file
named in the committed manifest counts, so lost executors leave nothing half-written in use.

Defined results: a null or empty text holds the end id alone; a special token's string in a
text is that token, as the library has it, or ordinary text with ``special_as_text``; whole
texts are encoded, however long; rows with a null key come first and are not indexed; of
repeated keys (sorted by text) the index knows the first, and all are read back in sequence;
a shard without rows has no file, so an empty table gives no rows; other columns may have any
name.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, materialize, mix64, sub_batches, text_rows

MAGIC = b"QGTOK002"
HEADER = "<8sII"  # magic, bytes of an id, end id
FOOTER = "<QQQQQQI8s"  # documents, ids, starts of keys, offsets, ordinals and index, crc32 of all tables, magic
INDEX_HEAD = "<IQQ"  # levels, bits, keys
HEADER_BYTES, FOOTER_BYTES, INDEX_HEAD_BYTES = struct.calcsize(HEADER), struct.calcsize(FOOTER), struct.calcsize(INDEX_HEAD)
#: Bits of a level for each key that is still to place.
GAMMA = 2.0
#: Bits between two stored counts of a hash index, a multiple of 8.
RANK_BITS = 512
#: Text bytes that are encoded together.
ENCODE_BYTES = 1 << 23
#: Bytes that a worker keeps of chunks and their ids, in each of two generations, and the longest chunk kept.
CACHE_BYTES, CACHE_LENGTH = 48 << 20, 64
#: Bytes of a chunk that is kept even if a step has it once.
SHORT = 3
#: What an entry takes beside its text and ids, about.
_ENTRY_BYTES = 220
_ODD_SPACES = re.compile(r"\s \s|  ")
#: What every text with odd spaces has; it is found faster.
_SPACE_BEFORE = re.compile(r" \s")


def _byte_marks() -> list[str]:
    """The character by which byte-level tokenizers write each byte: itself, or for white space and unseen ones the next from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(0x100)]


BYTE_MARKS = _byte_marks()
#: Bytes that UTF-8 never has; here they stand between two pieces and between two chunks.
NO_TEXT = (0xC0, 0xC1)
#: Pieces of a chunk in which each character counts for the pre-tokenizer as it does here, without apostrophes.
_PIECES = re.compile(r"[^\W\d_]+|\d+|\n|(?:[^\w\s]|_)+")


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys onto 0 .. n - 1; other keys are told apart by fingerprints."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, prints: np.ndarray):
        self.bits, self.sizes, self.prints = bits, sizes, prints
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.ranks = np.concatenate([[0], np.cumsum(bits)])

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys ^ mix64(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix64(keys + np.uint64(0x51ED270B)) >> np.uint64(32)).astype(np.uint32)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        left, levels, level = keys.astype(np.uint64), [], 0
        while left.size:
            size = max(64, int(GAMMA * left.size))
            slots = cls._slot(left, level, size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[slots]]
            level += 1
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        made = cls(bits, np.array([len(x) for x in levels], np.int64), np.zeros(len(keys), np.uint32))
        made.prints[made._place(keys.astype(np.uint64))] = cls._print(keys.astype(np.uint64))
        return made

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where no level holds it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.starts[level] + self._slot(keys[left], level, size)
            here = self.bits[at]
            out[left[here]] = self.ranks[at[here]]
            left = left[~here]
            if not left.size:
                break
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for keys that were not built in (but for one in 2**32)."""
        keys = keys.astype(np.uint64)
        out = self._place(keys)
        known = out >= 0
        known[known] = self.prints[out[known]] == self._print(keys[known])
        return np.where(known, out, -1)

    def dump(self) -> bytes:
        """Head, level sizes, counts of the bits before each RANK_BITS, bits, fingerprints."""
        before = self.ranks[: len(self.bits) : RANK_BITS] if len(self.bits) else np.zeros(0, np.int64)
        head = struct.pack(INDEX_HEAD, len(self.sizes), len(self.bits), len(self.prints))
        return head + self.sizes.astype("<i8").tobytes() + before.astype("<u8").tobytes() + np.packbits(self.bits).tobytes() + self.prints.astype("<u4").tobytes()

    @classmethod
    def load(cls, data: bytes) -> MinimalPerfectHash:
        at = IndexPlaces(data, 0)
        packed = np.frombuffer(data, np.uint8, -(-at.bits // 8), at.bits_at)
        return cls(np.unpackbits(packed)[: at.bits].astype(bool), at.sizes, np.frombuffer(data, "<u4", at.n, at.prints_at).copy())


class IndexPlaces:
    """Where the parts of a dumped index begin, from its first bytes (head and level sizes)."""

    def __init__(self, head: bytes, start: int):
        levels, self.bits, self.n = struct.unpack_from(INDEX_HEAD, head)
        self.sizes = np.frombuffer(head, "<i8", levels, INDEX_HEAD_BYTES)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.ranks_at = start + INDEX_HEAD_BYTES + 8 * levels
        self.bits_at = self.ranks_at + 8 * -(-self.bits // RANK_BITS)
        self.prints_at = self.bits_at + -(-self.bits // 8)


class Encoder:
    """A tokenizer with a cache of the ids of chunks.

    With a byte-level pre-tokenizer, a single space between other characters always opens a
    piece, so what lies between such spaces is encoded on its own, once, and kept. Where
    a chunk's pieces are plain runs of letters, numbers or signs, they go to the tokenizer's
    model without its pre-tokenizer, which takes more time than the model. Texts with other
    runs of white space or with the string of an added token, and other kinds of tokenizer,
    are encoded whole.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path) as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.by_chunk = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer") and not spec.get("post_processor")
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids if self.by_chunk else (0,)
        #: Characters met so far, and those that pre-tokenizer and ``_PIECES`` take alike.
        self.met, self.plain = set[str](), set[str]()
        self.marks, vocabulary = np.array([ord(m) for m in BYTE_MARKS], np.uint16), (spec.get("model") or {}).get("vocab") or {}
        self.marks[:2] = self.marks[list(NO_TEXT)]
        self.between = [vocabulary.get(BYTE_MARKS[b]) for b in NO_TEXT] if self.by_chunk else [None]
        merged = {c for m in spec["model"].get("merges") or [] for part in m for c in part} if self.by_chunk else set()
        self.merger = None
        if None not in self.between and not merged.intersection(BYTE_MARKS[b] for b in NO_TEXT):
            self.merger = Tokenizer(self.tokenizer.model)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of the young generation

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _meet(self, characters: set[str]) -> None:
        """Ask the pre-tokenizer of each new character whether it prolongs a piece as ``_PIECES`` has it."""
        for c in characters - self.met:
            begin = "a" if c.isalpha() else "1" if c.isdecimal() else "" if c.isalnum() or c.isspace() or c in "'\0\1" else "!"
            if c == "\n" or begin and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(begin + c)) == 1:
                self.plain.add(c)
        self.met |= characters

    def _chunk_ids(self, chunks: list[str], lead: str) -> list[bytes]:
        """Ids of each chunk behind ``lead``, a space or nothing.

        Pieces are told apart here where that is plain, and the model gets many at once: the
        marks between them stand for bytes that no text has and no merge knows.
        """
        if self.merger is None:
            return self._mixed_ids(chunks, lead)
        self._meet(set().union(*chunks))
        plain, out, cut, rest = self.plain.issuperset, dict[str, bytes](), [], []
        for c in chunks:
            if not c or not plain(c) or ("\n" in c and (c[0] == "\n" or c[-1] == "\n" or "\n\n" in c)):
                rest.append(c)
            else:
                cut.append(c)
        groups = [cut[i : i + 512] for i in range(0, len(cut), 512)]
        texts = [("\1" + lead).join([c if c.isalpha() else "\0".join(_PIECES.findall(c)) for c in g]) for g in groups]
        marked = [self.marks[np.frombuffer((lead + t).encode(), np.uint8)].tobytes().decode("utf-16-le") for t in texts]
        for group, e in zip(groups, self.merger.encode_batch_fast(marked, add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            ids = ids[ids != self.between[0]]
            ends = np.append(np.flatnonzero(ids == self.between[1]), len(ids))
            if len(ends) != len(group):
                raise ValueError("the tokenizer does not keep pieces apart")
            ends = (ends * self.width).tolist()
            raw = ids.tobytes()
            out.update(zip(group, [raw[a:b] for a, b in zip([0, *(x + self.width for x in ends)], ends)]))
        out.update(zip(rest, self._mixed_ids(rest, lead)))
        return [out[c] for c in chunks]

    def _mixed_ids(self, chunks: list[str], lead: str) -> list[bytes]:
        """Ids of chunks of any characters, by pre-tokenizer and model.

        Many chunks go through the tokenizer as one text: a line break between them is a
        piece and a token of its own, at which their ids are cut apart again. Chunks with
        white space where it would touch that line break go by themselves.
        """
        odd = [c for c in chunks if not c or c.strip() != c or "\n" in c]
        out = dict(zip(odd, self._ids([lead + c for c in odd])))
        plain = [c for c in chunks if c not in out] if odd else chunks
        groups = [plain[i : i + 512] for i in range(0, len(plain), 512)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([lead + ("\n" + lead).join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            cuts = np.flatnonzero(ids == self.line_break).tolist()
            if len(cuts) != len(group) - 1:
                raise ValueError("the tokenizer does not keep line breaks apart")
            raw, width = ids.tobytes(), self.width
            out.update((c, raw[a * width : b * width]) for c, a, b in zip(group, [0, *(x + 1 for x in cuts)], [*cuts, len(ids)]))
        return [out[c] for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Raw ids of each text, without special tokens."""
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.by_chunk or (_SPACE_BEFORE.search(t) and _ODD_SPACES.search(t)) or any(a in t for a in self.added)]
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        rows = [i for i in range(len(texts)) if out[i] is None]
        if rows:
            for i, ids in zip(rows, self._by_chunks([texts[i] for i in rows])):
                out[i] = ids
        return out  # type: ignore[return-value]

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        """Raw ids of texts whose single spaces open pieces.

        All chunks are numbered at once; each distinct one is looked up once, and the ids of
        all texts are gathered by those numbers.
        """
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        heads = np.zeros(code.size, bool)
        heads[ends[:-1]] = True  # the first chunk of a text has no space before it
        times = np.bincount(code[~heads], minlength=len(coded.dictionary))
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
        ids = list(map(self.young.get, chunks))
        for k in np.flatnonzero(times == 0).tolist():
            ids[k] = b""
        lacking = [k for k, x in enumerate(ids) if x is None]
        if self.old:
            for k in lacking:
                ids[k] = self.old.get(chunks[k])
        fresh = [k for k in lacking if ids[k] is None] if self.old else lacking
        for k, x in zip(fresh, self._chunk_ids([chunks[k] for k in fresh], " ")):
            ids[k] = x
        # What occurs once seldom comes again, unless it is short.
        again, missed = (times > 1) | (pc.binary_length(coded.dictionary).to_numpy() <= SHORT), np.array(lacking, np.int64)
        for k in missed[again[missed]].tolist():
            if len(chunks[k]) <= CACHE_LENGTH:
                self.young[chunks[k]] = ids[k]
                self.held += len(chunks[k]) + len(ids[k]) + _ENTRY_BYTES
        if self.held > CACHE_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        code[ends[:-1]] = len(ids) + np.arange(len(texts))
        ids += self._chunk_ids([chunks[k] for k in coded.indices.to_numpy()[ends[:-1]].tolist()], "")
        joined = pa.array(ids, pa.large_binary()).take(pa.array(code))
        places, raw = (np.frombuffer(x, t) for x, t in zip(joined.buffers()[1:], (np.int64, np.uint8)))
        cuts = places[ends].tolist()
        return [raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str, special_as_text: bool = False) -> Encoder:
    return Encoder(path, special_as_text)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


MANIFEST = "shard int, path string, documents long, ids long, first_key long, last_key long"


def write_store(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> DataFrame:
    """Write the shard files and return their manifest, with ``base``: the ids of all shards before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        target, sink, crc = "", None, 0
        keys, nulls, counts = array("q"), bytearray(), array("q")
        for batch in sub_batches(batches, "text", ENCODE_BYTES):
            encoder = _encoder(tokenizer_path, special_as_text)
            if sink is None:
                target = posixpath.join(out_dir, f"shard-{shard:06d}-{attempt}.qgtok")
                store, path = _open(target)
                store.create_dir(posixpath.dirname(path), recursive=True)
                sink = store.open_output_stream(path)
                sink.write(struct.pack(HEADER, MAGIC, encoder.width, end_id))
            end = np.array([end_id], encoder.kind).tobytes()
            for ids in encoder.encode([t or "" for t in batch.column("text").to_pylist()]):
                sink.write(ids + end)
                counts.append(len(ids) // encoder.width + 1)
            key = batch.column("doc_id")
            keys.frombytes(key.fill_null(0).to_numpy().tobytes())
            nulls += key.is_null().to_numpy(zero_copy_only=False).tobytes()
        if sink is None:
            return
        offsets = np.fromiter(accumulate(counts, initial=0), np.int64, len(counts) + 1)
        null, key_array = np.frombuffer(nulls, bool), np.frombuffer(keys, np.int64)
        distinct, place = np.unique(key_array[~null], return_index=True)
        place = np.flatnonzero(~null)[place]
        index = MinimalPerfectHash.build(distinct.view(np.uint64))
        ordinals = np.zeros(len(distinct), np.uint32)
        ordinals[index.find(distinct.view(np.uint64))] = place
        tables = [null.astype(np.uint8).tobytes() + key_array.astype("<i8").tobytes(), offsets.astype("<u8").tobytes(), ordinals.astype("<u4").tobytes(), index.dump()]
        starts = list(accumulate([len(x) for x in tables[:-1]], initial=HEADER_BYTES + int(offsets[-1]) * encoder.width))
        for part in tables:
            crc = zlib.crc32(part, crc)
            sink.write(part)
        sink.write(struct.pack(FOOTER, len(keys), int(offsets[-1]), *starts, crc, MAGIC))
        sink.close()
        known = key_array[~null]
        row = [[shard], [target], [len(keys)], [int(offsets[-1])], [int(known[0]) if known.size else None], [int(known[-1]) if known.size else None]]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["shard", "path", "documents", "ids", "first_key", "last_key"])

    rows = text_rows(docs, id_col, text_col)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = materialize(ordered.mapInArrow(run, MANIFEST), "token-manifest", narrow=True)
    # One small row for each shard, so one partition for the running sum is enough.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class Shard:
    """One shard file. Opening it reads the footer and the head of its index; ``get`` then reads a few slices a key."""

    def __init__(self, uri: str):
        self.uri = uri
        store, path = _open(uri)
        self.file = store.open_input_file(path)
        self.size = self.file.size()
        self.documents, self.ids, self.keys_at, self.offsets_at, self.ordinals_at, self.index_at, self.crc, magic = struct.unpack(FOOTER, self.file.read_at(FOOTER_BYTES, self.size - FOOTER_BYTES))
        first, self.width, self.end_id = struct.unpack(HEADER, self.file.read_at(HEADER_BYTES, 0))
        if magic != MAGIC or first != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        (levels,) = struct.unpack("<I", self.file.read_at(4, self.index_at))
        self.places = IndexPlaces(self.file.read_at(INDEX_HEAD_BYTES + 8 * levels, self.index_at), self.index_at)

    def _value(self, kind: str, at: int, count: int = 1) -> np.ndarray:
        return np.frombuffer(self.file.read_at(np.dtype(kind).itemsize * count, at), kind)

    def ordinal(self, key: int) -> int:
        """Place of a key's document in the shard, -1 if the shard lacks it, from slices of the index."""
        wanted, p = np.array([key], np.int64).view(np.uint64), self.places
        for level, size in enumerate(p.sizes.tolist()):
            bit = int(p.starts[level]) + int(MinimalPerfectHash._slot(wanted, level, size)[0])
            block = bit // RANK_BITS
            part = np.unpackbits(self._value("u1", p.bits_at + block * RANK_BITS // 8, (bit - block * RANK_BITS) // 8 + 1))
            if part[bit - block * RANK_BITS]:
                place = int(self._value("<u8", p.ranks_at + 8 * block)[0]) + int(part[: bit - block * RANK_BITS].sum())
                if self._value("<u4", p.prints_at + 4 * place)[0] != MinimalPerfectHash._print(wanted)[0]:
                    return -1
                found = int(self._value("<u4", self.ordinals_at + 4 * place)[0])
                return found if self._value("<i8", self.keys_at + self.documents + 8 * found)[0] == key else -1
        return -1

    def get(self, key: int) -> np.ndarray | None:
        """Ids of one document with their end id, or None."""
        at = self.ordinal(key)
        if at < 0:
            return None
        first, last = self._value("<u8", self.offsets_at + 8 * at, 2).tolist()
        return self.payload(first, last)

    def payload(self, first: int, last: int) -> np.ndarray:
        """Ids first to last - 1 of the shard."""
        return self._value(f"<u{self.width}", HEADER_BYTES + first * self.width, last - first)


class ShardTables:
    """All tables of a shard, tested against their checksum, for reading it whole."""

    def __init__(self, shard: Shard):
        raw = shard.file.read_at(shard.size - FOOTER_BYTES - shard.keys_at, shard.keys_at)
        if zlib.crc32(raw) != shard.crc:
            raise ValueError(f"{shard.uri}: checksum of the tables")
        n = shard.documents
        self.null = np.frombuffer(raw, np.uint8, n).astype(bool)
        self.keys = np.frombuffer(raw, "<i8", n, n)
        self.offsets = np.frombuffer(raw, "<u8", n + 1, shard.offsets_at - shard.keys_at).astype(np.int64)
        self.ordinals = np.frombuffer(raw, "<u4", (shard.index_at - shard.ordinals_at) // 4, shard.ordinals_at - shard.keys_at)
        self.index = MinimalPerfectHash.load(raw[shard.index_at - shard.keys_at :])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ordinal of each key in the shard, or -1."""
        place = self.index.find(keys.astype(np.int64).view(np.uint64))
        if not len(self.ordinals):
            return np.full(len(keys), -1)
        return np.where(place >= 0, self.ordinals[np.maximum(place, 0)].astype(np.int64), -1)


def read_store(manifest: DataFrame, step: int = 1 << 20, payload: bool = True) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 and, with ``payload``, ids (as u32).

    Every indexed key is found through the hash index; payloads are read ``step`` ids at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                shard = Shard(uri)
                tables = ShardTables(shard)
                offsets, known = tables.offsets, ~tables.null
                found = np.arange(shard.documents)
                found[known] = tables.find(tables.keys[known])
                if (found < 0).any():
                    raise ValueError(f"{uri}: a key is not indexed")
                repeat = np.concatenate([[False], (tables.keys[1:] == tables.keys[:-1]) & known[1:] & known[:-1]])
                found[repeat] = np.flatnonzero(repeat)
                first = 0
                while first < shard.documents:
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + step)) - 1)
                    last = min(last, shard.documents)
                    zero = int(offsets[first])
                    ids = shard.payload(zero, int(offsets[last]))
                    raw = [ids[offsets[k] - zero : offsets[k + 1] - zero].astype("<u4").tobytes() for k in found[first:last].tolist()]
                    keys = pa.array(tables.keys[first:last], pa.int64(), mask=tables.null[first:last])
                    columns = [keys, pa.array(base + offsets[found[first:last]]), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                    if payload:
                        columns.append(pa.array(raw, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                    first = last

    spark = manifest.sparkSession
    spread = manifest.select("path", "base").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * payload)


def fetch(spark: SparkSession, manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """ids of each key (``doc_id``) by keyed access: doc_id, ids (u32, with the end id); unknown keys give no row.

    The bounds of the shards (one row a shard) say which shard may hold a key; keys then
    meet their shard by its number.
    """
    shards = manifest.filter("first_key is not null").select("first_key", "last_key", "path").orderBy("first_key").collect()
    bounds = spark.sparkContext.broadcast((np.array([r[0] for r in shards], np.int64), np.array([r[1] for r in shards], np.int64), [r[2] for r in shards]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, _ = bounds.value
        for batch in batches:
            key = batch.column(0).to_numpy()
            shard = np.searchsorted(first, key, "right") - 1
            held = (shard >= 0) & (key <= last[np.maximum(shard, 0)]) if len(last) else np.zeros(len(key), bool)
            yield pa.RecordBatch.from_arrays([pa.array(shard[held].astype(np.int32)), pa.array(key[held])], ["shard", "doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = -1, None
        for batch in batches:
            out = []
            for wanted, key in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist()):
                if wanted != number:
                    number, shard = wanted, Shard(bounds.value[2][wanted])
                ids = shard.get(key)
                if ids is not None:
                    out.append((key, ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([v for _, v in out], pa.binary())], ["doc_id", "ids"])

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    routed = asked.mapInArrow(route, "shard int, doc_id long").repartition("shard")
    return routed.sortWithinPartitions("shard", "doc_id").mapInArrow(run, "doc_id long, ids binary")


def digests(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from freshly written shards."""
    manifest = write_store(docs, tokenizer_path, scratch_path(docs.sparkSession, "token-shards"), end_id)
    return read_store(manifest, payload=False)
