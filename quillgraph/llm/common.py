"""Helpers shared by the corpus operators: shared storage, Arrow text buffers, batching."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one vectorised step handles; a longer document makes a step of its own.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``. Where that is unset and everything runs in one
    process, as in tests, a temporary folder is made once and recorded in the session; on a
    cluster a missing setting is an error, as executors would write to disks of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quillgraph-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path of its own inside the shared folder."""
    return posixpath.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Tables written so far, by the session's application.
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder that goes with the scratch tables."""
    path = fresh_path(spark, name)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A lost executor costs only tasks of the current step, not what came before it.
    ``narrow`` is for tables of a few bytes per document: they are rebalanced, so the number
    of files follows their bytes and not the number of tasks that made them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if narrow:
        df = df.hint("rebalance")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(table: DataFrame) -> None:
    """Delete a materialised table that nothing will read again."""
    path, spark = table._scratch_path, table.sparkSession
    _SCRATCH[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables that were materialised in this application; call it once results are stored."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block whose materialised tables are deleted at its end, but for those stored with the function it gets."""
    mine = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
    before, kept = len(mine), set()

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        kept.add(out._scratch_path)
        return out

    try:
        yield keep
    finally:
        gone = [p for p in mine[before:] if p not in kept]
        mine[before:] = [p for p in mine[before:] if p in kept]
        for path in gone:
            _delete(spark, path)


#: Allocator settings of Python workers: large freed blocks go back to the system, as
#: several workers and a JVM share an executor's memory.
WORKER_ENVIRONMENT = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "16777216", "MALLOC_TRIM_THRESHOLD_": "16777216"}


def lean_workers(spark: SparkSession) -> None:
    """Apply ``WORKER_ENVIRONMENT`` to the Python workers of functions made from now on."""
    for name, value in WORKER_ENVIRONMENT.items():
        spark.sparkContext.environment.setdefault(name, value)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text alone, whatever else the table holds."""
    lean_workers(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def packed_rows(df: DataFrame, *columns: Column) -> DataFrame:
    """Each row of ``df`` as one struct ``row`` beside ``columns``, so that no name of its own can clash."""
    lean_workers(df.sparkSession)
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *columns)


def opened_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns back from ``row``."""
    return df.select(*(F.col("row").getField(c).alias(c) for c in columns))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` partitioned by keys for a grouped function whose time does not follow its bytes.

    The number of partitions is given, so they are not merged for being small.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def crc32_mod(column: str, m: int) -> Column:
    """crc32 of a column's text form, modulo ``m`` (the held-out split of the contracts)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def utf8_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and the n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    size = int(offsets[-1])
    data = np.frombuffer(column.buffers()[2], np.uint8, size) if size else np.zeros(0, np.uint8)
    return data[offsets[0] :], offsets - offsets[0]


def steps(sizes: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a larger row makes a range of its own."""
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def sub_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` (text or binary) holds about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        for a, b in steps(sizes, limit):
            yield batch.slice(a, b - a)


def binary_array(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over one buffer."""
    raw = data.tobytes() if isinstance(data, np.ndarray) else data
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_table(size: int, seed: int) -> np.ndarray:
    """``size`` fixed pseudo-random 64-bit values."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, size, dtype=np.uint64)
