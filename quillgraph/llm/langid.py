"""Language identification by nearest centroids.

A text is a vector of hashed character n-grams (one to three letters, words padded with
a space, lower case) with sublinear counts times inverse document frequency, at unit
length. Each language has several centroids, found by spherical k-means; a text goes to
the language of the centroid with the greatest cosine. A text farther from that centroid
than the language's own learned texts are (``REJECT`` quantile) is marked ``rejected``.

Document frequencies cover every learnable document. Centroids are fitted on a bounded
sample: the ``SAMPLE`` distinct texts of each language with the smallest hashes, so copies
count once and a language with one text that has letters is learned from that.

Defined results: a null text, or one without letters, is ``und`` with score 0 and
rejected; ties go to the language first in order; without learnable documents every
text is ``und``; repeated rows get equal results; a text labelled with several languages is
learned for each; whole texts are read, however long; an empty table gives no rows; columns
other than doc_id, text and lang may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_mod, materialize, sub_batches, text_rows

#: Buckets of hashed n-grams.
DIMENSIONS = 1 << 13
#: Sampled texts of each language for the centroids; languages whose sum is beyond MAX_SAMPLE share that, with one text each at least.
SAMPLE, MAX_SAMPLE = 300, 20_000
#: Centroids of each language.
CENTROIDS = 4
#: Share of a language's own sample that lies beyond its distance of rejection.
REJECT = 0.005

UNDETERMINED = "und"
_SEED = np.uint64(0x9E3779B1)


def _letters() -> np.ndarray:
    """Lower-case letter of each code point of the first plane, 0 for what is no letter."""
    table = np.zeros(0x10000, np.uint32)
    for cp in range(0x10000):
        char = chr(cp)
        if char.isalpha():
            low = char.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


class Vectors:
    """Sparse counts of hashed n-grams for many texts at once."""

    table: np.ndarray | None = None

    @classmethod
    def counts(cls, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(buckets, counts) of each text; empty arrays where it has no letter."""
        if cls.table is None:
            cls.table = _letters()
        joined = " ".join([t or "" for t in texts]) + " "
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        high = points > 0xFFFF
        letters = cls.table[np.where(high, 0, points)].astype(np.uint32)
        if high.any():  # letters beyond the first plane stand for themselves
            letters[high] = [c if chr(c).isalpha() else 0 for c in points[high].tolist()]
        # Runs of other characters become one blank, so words are padded by one place.
        keep = letters != 0
        keep[1:] |= letters[:-1] != 0
        ends = np.cumsum(np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts)))
        counts_before = np.concatenate([[0], np.cumsum(keep)])
        at = counts_before[np.concatenate([[0], ends])].tolist()
        c = letters[keep].astype(np.uint32)
        one = c * np.uint32(0x85EBCA6B)
        two = (one[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE35) + c[1:] * np.uint32(0x165667B1)
        three = (two[:-1] ^ np.uint32(0x9E3779B1)) * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0x2545F491)
        shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
        grams = [((g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift for g in (one, two, three)]
        out = []
        for a, b in zip(at, at[1:]):
            if b <= a or not c[a:b].any():
                out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
                continue
            total = np.bincount(np.concatenate([g[a : max(a, b - k)] for k, g in enumerate(grams)]), minlength=DIMENSIONS)
            buckets = np.flatnonzero(total)
            out.append((buckets.astype(np.int32), total[buckets].astype(np.float32)))
        return out


def _weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[buckets]
    norm = float(np.sqrt((values * values).sum()))
    return values / norm if norm else values


def _kmeans(rows: np.ndarray, k: int) -> np.ndarray:
    """Up to k unit centroids; seeds are the row nearest the mean and then, in turn, the farthest row."""
    mean = rows.mean(axis=0)
    seeds = [int(np.argmax(rows @ mean))]
    while len(seeds) < min(k, len(rows)):
        nearest = (rows @ rows[seeds].T).max(axis=1)
        nearest[seeds] = np.inf
        seeds.append(int(np.argmin(nearest)))
    centroids = rows[seeds]
    for _ in range(10):
        owner = np.argmax(rows @ centroids.T, axis=1)
        moved = np.stack([rows[owner == i].mean(axis=0) if (owner == i).any() else centroids[i] for i in range(len(centroids))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids


class Model:
    """Centroids of all languages and the distances of rejection."""

    def __init__(self, langs: list[str], idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray, least: np.ndarray):
        self.langs, self.idf, self.centroids, self.owner, self.least = langs, idf, centroids, owner, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = []
        for buckets, counts in Vectors.counts(texts):
            if not len(buckets) or not self.langs:
                out.append((UNDETERMINED, 0.0, True))
                continue
            cosines = self.centroids[:, buckets] @ _weighted(buckets, counts, self.idf)
            best = int(np.argmax(cosines))
            score = float(np.clip(cosines[best], 0, 1))
            lang = int(self.owner[best])
            out.append((self.langs[lang], score, score < self.least[lang]))
        return out


def fit(docs: DataFrame) -> Model:
    """Learn from the rows of ``docs`` (text, lang) whose lang is not null."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS + 1, np.int64), 0
        for batch in sub_batches(batches, "text"):
            for buckets, _ in Vectors.counts(batch.column("text").to_pylist()):
                total[buckets] += 1
                n += len(buckets) > 0
        total[DIMENSIONS] = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    df = np.zeros(DIMENSIONS + 1, np.int64)
    for bucket, n in known.select("text").mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[bucket] = n
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    # The smallest text hashes of each language: copies are one text, and no language is left out.
    hashed = known.filter(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    distinct = materialize(hashed.select("lang", "h").distinct(), "text-hashes", narrow=True)
    # Hashes are even, so a bound keeps about 4 * SAMPLE of a large language before its rows meet in one task to be ranked.
    counts = distinct.groupBy("lang").agg(F.count("*").alias("n"))
    low = F.pmod("h", F.lit(1 << 32))
    bound = F.when(F.col("n") > 8 * SAMPLE, F.lit(4.0 * SAMPLE * (1 << 32)) / F.col("n")).otherwise(float(1 << 32))
    few = distinct.join(F.broadcast(counts), "lang").filter(low < bound)
    ranked = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(low, "h"))).filter(F.col("k") <= SAMPLE)
    chosen = materialize(ranked.select("lang", "h", "k"), "language-sample", narrow=True)
    n_langs = chosen.select("lang").distinct().count()
    each = max(1, min(SAMPLE, MAX_SAMPLE // max(1, n_langs)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            found = Vectors.counts(batch.column("text").to_pylist())
            columns = [batch.column("lang"), batch.column("h"), pa.array([b.tobytes() for b, _ in found], pa.binary()), pa.array([c.tobytes() for _, c in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "h", "buckets", "counts"])

    # At most MAX_SAMPLE rows, or one for each language where there are more languages than that.
    keys = chosen.filter(F.col("k") <= each).select("lang", "h")
    texts = hashed.join(F.broadcast(keys), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample = texts.mapInArrow(vectors, "lang string, h long, buckets binary, counts binary").filter("length(buckets) > 0").orderBy("lang", "h")
    by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in sample.toLocalIterator():
        buckets, counts = np.frombuffer(row["buckets"], np.int32), np.frombuffer(row["counts"], np.float32)
        by_lang.setdefault(row["lang"], []).append((buckets, _weighted(buckets, counts, idf)))
    langs = sorted(by_lang)
    parts, owner, least = [], [], []
    for i, lang in enumerate(langs):
        rows = np.zeros((len(by_lang[lang]), DIMENSIONS), np.float32)
        for row, (buckets, values) in zip(rows, by_lang[lang]):
            row[buckets] = values
        found = _kmeans(rows, CENTROIDS)
        parts.append(found)
        owner += [i] * len(found)
        least.append(float(np.quantile((rows @ found.T).max(axis=1), REJECT)))
    centroids = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, DIMENSIONS), np.float32)
    return Model(langs, idf, centroids, np.array(owner, np.int64), np.array(least))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            out = shared.value.predict(batch.column("text").to_pylist())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "rejected"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; rows with crc32(doc_id) mod ``folds`` 0 are never learned from.

    A row whose doc_id is null counts as not held out.
    """
    held_out = F.coalesce(crc32_mod("doc_id", folds) == 0, F.lit(False))
    model = fit(docs.filter(~held_out).select("text", "lang"))
    return predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "rejected")
