"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import posixpath
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting for shuffles to be deleted at the end of the statement that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Whether rows that are dealt by some of a join's keys are dealt anew by all of them.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Paths written so far, by application.
_WRITTEN: dict[str, list[str]] = {}
#: Paths written since each open ``scratch`` block of a thread began.
_BLOCKS = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quillgraph-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted by ``clear``."""
    path = posixpath.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    for paths in [_WRITTEN.setdefault(spark.sparkContext.applicationId, []), *getattr(_BLOCKS, "open", [])]:
        paths.append(path)
    return path


def write(df: DataFrame, path: str) -> None:
    """``df`` as Parquet. Its shuffles are deleted once it is written, not at some later collection of the driver's garbage."""
    with set_to(df.sparkSession, CLEANUP, "true"):
        df.write.parquet(path, compression="zstd")


@contextmanager
def set_to(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A block in which a setting of the session has another value."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: computed once, with known size, and not again if an executor is lost."""
    path = new_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block whose tables are deleted at its end, but for those stored with the function it gets; what it leaves must be made of these."""
    mine, kept = [], set()
    _BLOCKS.open = [*getattr(_BLOCKS, "open", []), mine]

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        kept.add(mine[-1])
        return out

    try:
        yield keep
    finally:
        _BLOCKS.open = [b for b in _BLOCKS.open if b is not mine]
        known = _WRITTEN.get(spark.sparkContext.applicationId, [])
        for path in mine:
            if path not in kept:
                _delete(spark, path)
                if path in known:
                    known.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Delete what was stored in this application; call it once results are written."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
