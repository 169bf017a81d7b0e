"""Hard negatives: exact search by inner product over ball trees, one tree per slice of the vectors.

Vectors become whole numbers, are dealt over tasks by their id, and each task packs slices of
them as ball trees (centre, radius and smallest id of each node). Anchors are a stated query
set; they visit all trees in blocks of a stated size. From a node's ball follow an upper and a
lower bound of the inner product of each anchor with all that the node holds, so a node is
left out if its best possible score (or, at an equal score, its smallest id) cannot enter the
anchor's best so far, or if the scores that it can hold miss the wanted window. What remains
at the leaves is scored exactly. Each task keeps the best of all its trees; they meet by anchor.

Defined results: rows with a null id, label or vector, or a null or non-finite component take
no part; of rows that repeat an id that of the smallest (label, vector) takes part; ties go to
the smaller id; equal vectors are all candidates; vectors of different lengths are compared as
if filled with zeros, so an empty vector scores 0; components beyond ``CLAMP`` after scaling
are set to it, which keeps scores within 64 bits for up to 2,048 components; an anchor without
positives, or a positive without negatives in its window, gives no rows (a negative score of a
positive has an empty window); an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean_workers, materialize, union_all

#: Vectors of one tree, and of a leaf.
TREE, LEAF = 4096, 64
#: Anchors that visit all trees at once; what is broadcast is at most this many of them.
BLOCK = 32_768
#: Anchors whose scores with a leaf are held at once.
LANE = 2048
CLAMP = 1 << 26
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max


class BallTree:
    """Vectors in tree order, with the balls of a complete binary tree over them, level by level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> BallTree:
        """Halves nodes at the median of their widest component until ``LEAF`` vectors are left."""
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        order = np.arange(len(ids))
        for level in range(cls.depth(len(ids))):
            for a, b in cls.nodes(len(ids), level):
                part = vectors[order[a:b]]
                if part.shape[1]:
                    widest = int(np.argmax(part.max(0) - part.min(0)))
                    order[a:b] = order[a:b][np.argpartition(part[:, widest], (b - a) // 2)]
        return cls(ids[order], labels[order], vectors[order])

    @staticmethod
    def depth(n: int) -> int:
        return max(int(np.ceil(np.log2(n / LEAF))), 0) if n else 0

    @staticmethod
    def nodes(n: int, level: int) -> list[tuple[int, int]]:
        cuts = [0, n]
        for _ in range(level):
            cuts = [x for a, b in zip(cuts, cuts[1:]) for x in (a, a + (b - a) // 2)] + [n]
        return list(zip(cuts, cuts[1:]))

    def balls(self) -> list[list[tuple[int, int, np.ndarray, float, int]]]:
        """(first, last, centre, radius, smallest id) of the nodes of each level."""
        out = []
        for level in range(self.depth(len(self.ids)) + 1):
            row = []
            for a, b in self.nodes(len(self.ids), level):
                part = self.vectors[a:b].astype(np.float64)
                centre = part.mean(0)
                row.append((a, b, centre, float(np.sqrt(((part - centre) ** 2).sum(1).max())), int(self.ids[a:b].min())))
            out.append(row)
        return out


class Queries:
    """A block of anchors with, for each, the window of scores that is wanted and the best ones so far.

    ``owner`` says which anchor a query belongs to; without windows each anchor is one query for
    rows of its own label, with windows each of its positives is one for rows of other labels.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.ids, self.labels, self.vectors, self.owner, self.low, self.high, self.same, self.k = ids, labels, vectors, owner, low, high, same, k
        self.score = np.full((len(owner), k), _NONE)
        self.found = np.full((len(owner), k), _LAST)

    def visit(self, tree: BallTree) -> None:
        width = max(self.vectors.shape[1], tree.vectors.shape[1])
        rows, anchors = _widened(tree.vectors, width), _widened(self.vectors, width)
        # Sums below 2^53 are exact in floating point, where products of matrices are fast.
        exact = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(width, 1) < 2**53
        rows, anchors = (x.astype(np.float64 if exact else np.int64) for x in (rows, anchors))
        balls = tree.balls()
        for first in range(0, len(self.owner), LANE):
            self._visit(tree, balls, rows, anchors, np.arange(first, min(first + LANE, len(self.owner))))

    def _visit(self, tree: BallTree, balls: list, rows: np.ndarray, anchors: np.ndarray, lane: np.ndarray) -> None:
        members = np.unique(self.owner[lane])
        place = np.searchsorted(members, self.owner[lane])
        q = anchors[members].astype(np.float64)
        norm = np.sqrt((q**2).sum(1))
        alive = np.ones((len(lane), 1), bool)
        for level in balls:
            if len(level) > alive.shape[1]:
                alive = np.repeat(alive, 2, axis=1)
            centres = _widened(np.array([x[2] for x in level]), q.shape[1])
            middle, reach = q @ centres.T, norm[:, None] * np.array([x[3] for x in level])
            slack = 1e-6 + 1e-12 * (norm[:, None] * np.sqrt((centres**2).sum(1)) + reach)
            # Scores are whole numbers, so bounds may be rounded to those within them.
            most = np.floor(np.clip(middle + reach + slack, -9e18, 9e18)).astype(np.int64)
            least = np.ceil(np.clip(middle - reach - slack, -9e18, 9e18)).astype(np.int64)
            alive &= (most[place] >= self.low[lane, None]) & (least[place] <= self.high[lane, None])
            alive &= self._may_enter(lane, most[place], np.array([x[4] for x in level]))
        # Leaves of the highest bounds first, so the best so far rise early.
        for j in np.argsort(-most.max(0), kind="stable").tolist():
            a, b, _, _, smallest = balls[-1][j]
            at = np.flatnonzero(alive[:, j])
            at = at[self._may_enter(lane[at], most[place[at], j][:, None], np.array([smallest]))[:, 0]]
            if len(at):
                score = (anchors[members[place[at]]] @ rows[a:b].T).astype(np.int64)
                self._merge(lane[at], score, tree.ids[a:b], tree.labels[a:b])

    def _may_enter(self, at: np.ndarray, most: np.ndarray, smallest: np.ndarray) -> np.ndarray:
        last, held = self.score[at, -1:], self.found[at, -1:]
        return (most > last) | ((most == last) & (smallest < held))

    def _merge(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        owner = self.owner[at]
        fits = (labels == self.labels[owner][:, None]) == self.same
        fits &= (ids != self.ids[owner][:, None]) & (score >= self.low[at, None]) & (score <= self.high[at, None])
        fits &= self._may_enter(at, score, ids)
        some = np.flatnonzero(fits.any(1))
        if not len(some):
            return
        at, fits = at[some], fits[some]
        score = np.concatenate([self.score[at], np.where(fits, score[some], _NONE)], axis=1)
        found = np.concatenate([self.found[at], np.where(fits, ids, _LAST)], axis=1)
        best = np.lexsort((found, -np.maximum(score, -_LAST)), axis=1)[:, : self.k]
        self.score[at], self.found[at] = np.take_along_axis(score, best, 1), np.take_along_axis(found, best, 1)


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _matrix(column: pa.ListArray, scale: float | None) -> np.ndarray:
    """Lists as the rows of one matrix of whole numbers, filled with zeros."""
    sizes = np.asarray(column.value_lengths())
    values = np.asarray(column.flatten())
    if scale is not None:
        values = np.clip(np.floor(values.astype(np.float64) * scale), -CLAMP, CLAMP)
    out = np.zeros((len(column), int(sizes.max(initial=0))), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values.astype(np.int32)
    return out


_ROWS = "ids binary, labels binary, width int, vectors binary"


def _packed(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[pa.Array]:
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (ids.astype(np.int64), labels.astype(np.int64), vectors.astype(np.int32))]
    return [*blobs[:2], pa.array([vectors.shape[1]], pa.int32()), blobs[2]]


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
        labels = np.frombuffer(batch.column("labels")[i].as_py(), np.int64)
        yield ids, labels, np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).reshape(len(ids), batch.column("width")[i].as_py())


def plant_trees(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """Ball trees over ``rows`` (vec_id, label, vector), one per row; ids are taken once each."""
    usable = rows.filter("vec_id is not null and label is not null and vector is not null").filter(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    # The same shuffle brings repeated ids together and deals the vectors out.
    one = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def tree() -> pa.RecordBatch:
            width = max(h[2].shape[1] for h in held)
            ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            grown = BallTree.build(ids, labels, np.concatenate([_widened(h[2], width) for h in held]))
            return pa.RecordBatch.from_arrays(_packed(grown.ids, grown.labels, grown.vectors), ["ids", "labels", "width", "vectors"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, TREE - sum(len(h[0]) for h in held))
                at += part.num_rows
                held.append((np.asarray(part.column("vec_id")), np.asarray(part.column("label")), _matrix(part.column("vector"), scale)))
                if sum(len(h[0]) for h in held) == TREE:
                    yield tree()
                    held.clear()
        if held:
            yield tree()

    return one.mapInArrow(pack, _ROWS)


def _anchor_blocks(trees: DataFrame, every: int, block: int) -> tuple[DataFrame, int]:
    """The vectors whose id is divisible by ``every``, each in one of a counted number of blocks."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, vectors in _unpacked(batch):
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    columns = [pa.array(ids[at]), pa.array(labels[at]), pa.array(list(vectors[at]), pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector"])

    found = materialize(trees.mapInArrow(pick, "vec_id long, label long, vector array<int>"), "anchors", narrow=True)
    blocks = -(-found.count() // block)
    return found.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1)))), blocks


def _search(trees: DataFrame, queries: Queries) -> DataFrame:
    """query, score, found: the best of each task for each query; the block of queries is broadcast."""
    shared = trees.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        mine = Queries(held.ids, held.labels, held.vectors, held.owner, held.low, held.high, held.same, held.k)
        for batch in batches:
            for ids, labels, vectors in _unpacked(batch):
                mine.visit(BallTree(ids, labels, vectors))
        query, rank = np.nonzero(mine.score != _NONE)
        columns = [pa.array(query), pa.array(mine.score[query, rank]), pa.array(mine.found[query, rank])]
        yield pa.RecordBatch.from_arrays(columns, ["query", "score", "found"])

    best = trees.mapInArrow(run, "query long, score long, found long")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    return best.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= queries.k)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, block: int = BLOCK) -> DataFrame:
    """Hard negatives of every anchor (id divisible by ``every``) and each of its first positives.

    ``rows`` has vec_id, label, vector. A negative's score is from ``low`` to ``high`` per cent
    of the positive's. Gives anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = rows.sparkSession
    lean_workers(spark)
    trees = materialize(plant_trees(rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>")), scale), "ball-trees")
    anchors, blocks = _anchor_blocks(trees, every, block)
    results = []
    for b in range(blocks):
        table = anchors.filter(F.col("block") == b).orderBy("vec_id").toArrow()
        ids, labels = np.asarray(table["vec_id"]), np.asarray(table["label"])
        vectors = _matrix(table["vector"].combine_chunks(), None)
        everything = np.full(len(ids), _NONE + 1), np.full(len(ids), _LAST)
        near = _search(trees, Queries(ids, labels, vectors, np.arange(len(ids)), *everything, True, positives)).orderBy("query", "rank").toArrow()
        owner, score, positive = (np.asarray(near[c]) for c in ("query", "score", "found"))
        lowest, highest = -(-(low * score) // 100), high * score // 100
        wanted = Queries(ids, labels, vectors, owner, lowest, highest, False, negatives)
        # A few numbers for each anchor of this block come along, so ids need no join.
        stated = spark.createDataFrame(pa.table({"query": np.arange(len(owner)), "anchor_id": ids[owner], "positive_id": positive, "positive_score": score}))
        found = _search(trees, wanted).join(F.broadcast(stated), "query")
        columns = ["anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
        results.append(materialize(found.select(*columns), "hard-negatives", narrow=True))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return union_all(results)
