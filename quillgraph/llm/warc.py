"""WARC archives: writing with revisit records, and reading into a chunked record table.

Records are gzip members of their own. A payload of at least ``REVISIT_BYTES`` bytes that
others equal is stored once, in the record of the largest page_id; the others are
revisit records that refer to it. Both ways stream: to be written, a payload becomes rows of
record id, chunk number and chunk before it reaches a Python worker; reading makes such rows
again, with an incremental digest. No worker holds a record whole.

Each task attempt writes files of its own and only files in the committed manifest are read.

Defined results: null and empty html are records with an empty payload, one empty chunk; rows
with a null page_id are response records and are never referred to; repeated rows are records
each, whose ids end in a copy number; payloads of any length are whole; an empty table gives no
archives and no rows; columns other than page_id, url and html may have any name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path, lean_workers, materialize, sub_batches

REVISIT_BYTES = 1000
#: Compressed bytes of an archive after which the next one is begun.
ARCHIVE_BYTES = 256 << 20
#: Payload bytes of a row of the chunked record table.
CHUNK_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"
#: Tasks that share the pages of one payload when they are told which record they refer to.
SALTS = 8


def _urn(page_id: Column) -> Column:
    return F.concat_ws(":", F.lit(_URN.rstrip(":")), F.coalesce(page_id.cast("string"), F.lit("none")), F.col("digest"))


def plan_records(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses), record_id and refers_id of every page.

    Payloads are shuffled once, by page and digest, so no payload is a hot key.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    light = rows.filter((F.length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    stored = light.groupBy("digest").agg(F.max("page_id").alias("keep"), F.min("page_id").alias("low")).filter("keep <> low").select("digest", "keep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = light.distinct().withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    refers = salted.join(stored, ["digest", "salt"]).filter("keep <> page_id").select("page_id", "digest", F.col("keep").alias("refers_to"))
    joined = rows.join(refers.hint("merge"), ["page_id", "digest"], "left")
    copy = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url"))
    urn = _urn(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "digest", "refers_to",
        F.when(copy > 1, F.concat_ws(":", urn, copy)).otherwise(urn).alias("record_id"),
        F.when(F.col("refers_to").isNotNull(), _urn(F.col("refers_to"))).alias("refers_id"),
    )


def _chunked(records: DataFrame, size: int) -> DataFrame:
    """One row for each chunk of a record; a revisit record has an empty one."""
    count = F.greatest(F.ceil(F.length("payload") / F.lit(size)), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("payload"), i * size + 1, F.lit(size)))
    chunks = F.when(F.col("refers_id").isNull(), cut).otherwise(F.array(F.lit("").cast("binary")))
    return records.select("record_id", "url", "digest", "refers_id", F.length("payload").cast("long").alias("size"), chunks.alias("chunks")).select(
        "record_id", "url", "digest", "refers_id", "size", F.size("chunks").alias("n"), F.posexplode("chunks").alias("chunk_no", "chunk")
    )


def _record(kind: str, record_id: str, url: str | None, digest: str, size: int, refers_id: str | None, date: str) -> bytes:
    """The header of a record whose block has ``size`` bytes."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {(url or '').translate({10: '%0A', 13: '%0D', 32: '%20'})}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_id is not None:
        lines += [f"WARC-Refers-To: <{refers_id}>", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {size}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(records: DataFrame, out_dir: str, date: str = "2024-01-01T00:00:00Z", level: int = 1, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Write ``plan_records``' rows as .warc.gz files; returns the manifest (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, sink, target, written, records, done = None, None, "", 0, 0, []
        packer, seen = None, hashlib.sha1()

        def put(data: bytes) -> None:
            nonlocal written
            written += len(data)
            sink.write(data)

        for batch in sub_batches(batches, "chunk"):
            for record_id, url, digest, refers_id, size, n, number, data in zip(*(batch.column(c).to_pylist() for c in ("record_id", "url", "digest", "refers_id", "size", "n", "chunk_no", "chunk"))):
                if sink is None:
                    target = posixpath.join(out_dir, f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}.warc.gz")
                    store, path = fs.FileSystem.from_uri(target)
                    store.create_dir(posixpath.dirname(path), recursive=True)
                    sink, written, records = store.open_output_stream(path), 0, 0
                if number == 0:
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                    revisit = refers_id is not None
                    packer, seen = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha1()
                    put(packer.compress(_record("revisit" if revisit else "response", record_id, url, digest, len(http) + (0 if revisit else size), refers_id, date) + http))
                put(packer.compress(data))
                seen.update(data)
                if number == n - 1:
                    if refers_id is None and seen.hexdigest() != digest:
                        raise ValueError(f"{record_id}: the chunks do not add up to the payload")
                    put(packer.compress(b"\r\n\r\n") + packer.flush())
                    records += 1
                    if written >= ARCHIVE_BYTES:
                        sink.close()
                        sink = None
                        done.append((target, records))
        if sink is not None:
            sink.close()
            done.append((target, records))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    lean_workers(records.sparkSession)
    return materialize(_chunked(records, chunk).mapInArrow(run, "path string, records long"), "warc-manifest", narrow=True)


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_records(stream: io.BufferedIOBase, chunk: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of one decompressed archive; a payload without bytes has one empty chunk."""
    while first := stream.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = _headers(stream)
        left = int(head["content-length"])
        length = None
        if head.get("content-type", "").startswith("application/http"):
            status = stream.readline()
            left -= len(status)
            while (line := stream.readline()):
                left -= len(line)
                if not line.strip():
                    break
                name, _, value = line.decode("utf-8", "replace").partition(":")
                if name.strip().lower() == "content-length":
                    length = int(value)
        stated = head.get("warc-payload-digest", "")
        digest, number, seen = hashlib.sha1(), 0, 0
        base = {
            "record_id": head.get("warc-record-id", "").strip("<>"),
            "record_type": head.get("warc-type", ""),
            "url": head.get("warc-target-uri"),
            "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
            "stated_digest": base64.b32decode(stated[5:]).hex() if stated.startswith("sha1:") else None,
            "stated_bytes": length,
        }
        while True:
            data = stream.read(min(chunk, left))
            if not data and left:
                raise ValueError("a record is cut off")
            left -= len(data)
            seen += len(data)
            digest.update(data)
            yield base | {"chunk_no": number, "chunk": data, "bytes_so_far": seen, "digest_so_far": digest.hexdigest(), "last": left == 0}
            number += 1
            if not left:
                break


CHUNKS = "record_id string, record_type string, url string, refers_to string, stated_digest string, stated_bytes long, chunk_no long, chunk binary, bytes_so_far long, digest_so_far string, last boolean"
_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("stated_digest", pa.string()), ("stated_bytes", pa.int64())]
    + [("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())]
)


def _read(manifest: DataFrame, chunk: int, last_only: bool) -> DataFrame:
    kept = _ARROW.remove(_ARROW.get_field_index("chunk")) if last_only else _ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                rows, size = [], 0
                with store.open_input_stream(path) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) as stream:
                    for row in read_records(stream, chunk):
                        data = row.pop("chunk") if last_only else row["chunk"]
                        if last_only and not row["last"]:
                            continue
                        rows.append(row)
                        size += (0 if last_only else len(data)) + 500
                        if size >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, kept)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kept)

    spread = manifest.select("path").repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(run, CHUNKS.replace("chunk binary, ", "") if last_only else CHUNKS)


def read_archives(manifest: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives named in ``manifest`` (path)."""
    return _read(manifest, chunk, False)


def read_totals(manifest: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The last row of each record in the chunked record table, without its chunk: payloads are read and digested, and stay in the worker."""
    return _read(manifest, chunk, True)


def report(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from archives."""
    manifest = write_archives(plan_records(pages), out_dir or scratch_path(pages.sparkSession, "warc"))
    last = read_totals(manifest)

    def page(column: str) -> Column:
        return F.expr(f"try_cast(split_part({column}, ':', {_URN.count(':') + 1}) as long)")

    revisit = F.col("record_type") == "revisit"
    return last.select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
