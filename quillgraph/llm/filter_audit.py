"""Filter interaction audit: which of several document filters removes what, in every order.

One pass scans Arrow text buffers (byte classes, prefix sums, verified word hashes) and gives
each document a mask of the filters that it fails; a duplicate filter is decided across the
table by digests. Masks are all that is left of a text: they are counted by part and label,
and the 32 counts of a part give the results of all 120 orders by one matrix product, so no
document is filtered 120 times.

Filters: A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals A-Z > 5 *
code points; D holds one of ``#$%&*|``; E equals the text of a smaller doc_id.

Defined results: a null text is an empty one (fails A only, and E like any other text); a null
source is the part of the empty string, together with empty sources; rows with a null doc_id
are judged by A to D, never fail E, make nothing fail E and have no label; rows that repeat a
doc_id and a text count as often as they stand there, and neither is a duplicate of the other;
of several labels of one document one that says 1 is enough; null labels say nothing; whole
texts are read, however long; an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean_workers, materialize, sub_batches, utf8_buffers
from .scan import BLANK, CAPITAL, LEADING, byte_class, count_class, repeats, span_hashes, spans

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
SYMBOL = byte_class(b"#$%&*|")
DUPLICATE = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(column: pa.Array) -> np.ndarray:
    """The mask of filters A to D that each text fails (bit 0 is A)."""
    data, offsets = utf8_buffers(column)
    n = len(offsets) - 1
    text, start, end = spans(data, offsets, BLANK)
    words = np.bincount(text, minlength=n)
    distinct = words - repeats(data, text, start, end, span_hashes(data, start, end), n)
    fails = [
        words < MIN_WORDS,
        100 * distinct < DISTINCT_PERCENT * words,
        100 * count_class(data, offsets, CAPITAL) > CAPITAL_PERCENT * count_class(data, offsets, LEADING),
        count_class(data, offsets, SYMBOL) > 0,
    ]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sub_batches(batches, "text"):
        text = batch.column("text")
        data, offsets = utf8_buffers(text)
        digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(failures(text), pa.int32()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all filters), good, toxic, n: how many documents of each kind there are."""
    lean_workers(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    )
    scanned = rows.mapInArrow(_masked, "doc_id long, part string, mask int, digest binary")
    # Repeated rows become one with a count, so that no key of the joins below is hot.
    scanned = materialize(scanned.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n")), "filter-masks", narrow=True)
    known = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    # Null ids would all go to one task of the joins; they have no partner anyway.
    named, loose = scanned.filter("doc_id is not null"), scanned.filter("doc_id is null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    judged = named.join(known, "doc_id", "left").join(first, ["doc_id", "digest"], "left")
    judged = judged.select("part", "mask", "n", "good", "toxic", F.col("first").isNull().alias("copy"))
    judged = judged.unionByName(loose.select("part", "mask", "n", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"), F.lit(False).alias("copy")))
    mask = F.col("mask") + F.when(F.col("copy"), DUPLICATE).otherwise(0)
    flags = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    return judged.groupBy("part", mask.alias("mask"), *flags).agg(F.sum("n").alias("n"))


def _weights() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """(order, step) of each result row, and for each count the share (0, 1 or orders) of every mask in it."""
    rows: list[tuple[str, int]] = []
    shares: dict[str, list[np.ndarray]] = {c: [] for c in ("kept", "removed", "redundant", "unique_fails", "shapley")}
    mask = np.arange(MASKS)
    size = np.array([max(int(m).bit_count(), 1) for m in mask])
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            fails, earlier = (mask & bit) > 0, (mask & before) > 0
            before |= bit
            rows.append(("".join(order), step))
            shares["kept"].append((mask & before) == 0)
            shares["removed"].append(fails & ~earlier)
            shares["redundant"].append(fails & earlier)
            shares["unique_fails"].append(mask == bit)
            # Of the filters that a document fails each comes first in an equal share of the orders.
            shares["shapley"].append(fails * (factorial(len(FILTERS)) // size))
    return rows, {c: np.array(m, np.int64) for c, m in shares.items()}


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, shares = _weights()
    order, step = pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32())
    names = ["part", "filter_order", "step", *COUNTS]
    for batch in batches:
        for row in batch.to_pylist():
            total = np.zeros((3, MASKS), np.int64)
            for c in row["counts"]:
                total[:, c["mask"]] = c["n"], c["good"], c["toxic"]
            found = {c: m @ total[0] for c, m in shares.items()}
            found |= {"good_lost": shares["removed"] @ total[1], "toxic_lost": shares["removed"] @ total[2]}
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(rows)), order, step, *(pa.array(found[c]) for c in COUNTS)], names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of ``COUNTS``."""
    kinds = masks(docs, labels)
    by_mask = kinds.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    # At most 32 entries for each part.
    by_part = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return by_part.mapInArrow(_orders, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def remove_failing(docs: DataFrame, order: str = FILTERS) -> DataFrame:
    """``docs`` as the filters of ``order`` (any of A to D) leave them."""
    if not set(order) <= set(FILTERS[:4]):
        raise ValueError("only filters A to D judge a row by itself")
    wanted = sum(1 << FILTERS.index(c) for c in set(order))
    lean_workers(docs.sparkSession)

    @F.pandas_udf("int")
    def fails(text):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(failures(pa.array(text, pa.string())))

    return docs.filter(fails(F.col("text").cast("string")).bitwiseAND(wanted) == 0)
