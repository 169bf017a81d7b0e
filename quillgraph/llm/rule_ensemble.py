"""Quality classifier: a sparse ensemble of rules over text statistics, scored by Spark expressions.

One pass over Arrow text buffers gives each document a row of ``STATISTICS``. Boosted trees are
grown on a bounded sample of labelled rows; every node's path is a conjunction of comparisons,
a rule. Logistic weights of rules and of the statistics themselves are fitted with a lasso
penalty, chosen by cross-validation, which leaves few of them. The rules that are left become
one Spark column expression, so scoring needs no model object and no Python beyond the scan.

Sample bound: ``SAMPLE`` labelled rows of each label, those of the smallest hashes of doc_id.
The share of good documents is counted over all labels that may be learned from.

Defined results: null and empty texts are scored like others, by the statistics of an empty
text; whole texts are read, however long; without labels of both kinds every score is the share
of good labels (0 without any); of several labels of one document a bad one counts; null labels
and null doc_ids are not learned from, but rows with a null doc_id are scored; rows that repeat
a doc_id are scored by their own texts (the smallest text is learned from); results do not
depend on how rows are partitioned; an empty table gives no rows; columns other than doc_id and
text may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, materialize, mix64, sub_batches, text_rows, utf8_buffers
from .scan import BLANK, CAPITAL, LEADING, byte_class, count_class, repeats, span_hashes, spans
from .toxicity import Trees

#: Labelled rows of each label that are learned from, at most.
SAMPLE = 3000
THRESHOLD = 0.7
FOLDS = 3
#: Penalties that are tried, as shares of the one that leaves no weight.
PENALTIES = (0.3, 0.1, 0.03, 0.01, 0.003)
STEPS = 250
#: A rule must hold for this share of the sample, and fail for it.
SUPPORT = 0.005
STATISTICS = [
    "log_words", "log_lines", "mean_word", "longest_word", "short_words", "distinct_words", "distinct_pairs", "distinct_lines", "same_as_before",
    "capitals", "symbols", "exclaims", "marks", "stops", "digits", "foreign", "blanks", "marked_words",
]

_SYMBOL = byte_class(b"#$%&*|@^~_=<>\\{}[]+/")
_EXCLAIM, _STOP, _DIGIT = byte_class(b"!?"), byte_class(b"."), byte_class(b"0123456789")
_MARK = byte_class(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_FOREIGN, _LINE = byte_class(bytes(range(0x80, 0x100))), byte_class(b"\n")


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    data, offsets = utf8_buffers(column)
    n = len(offsets) - 1
    text, start, end = spans(data, offsets, BLANK)
    hashes, size = span_hashes(data, start, end), end - start
    words = np.bincount(text, minlength=n)
    within = text[1:] == text[:-1]
    # Pairs of neighbours are told apart by their hashes alone: a statistic, not a count that must be exact.
    of, pair = text[1:][within], mix64(hashes[:-1][within] * np.uint64(3) + hashes[1:][within])
    order = np.lexsort((pair, of))
    of, pair = of[order], pair[order]
    again = of[1:][(of[1:] == of[:-1]) & (pair[1:] == pair[:-1])]
    same = text[1:][within & (hashes[1:] == hashes[:-1])]
    line_text, line_start, line_end = spans(data, offsets, _LINE)
    lines = np.bincount(line_text, minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, text, size)
    per_char, per_word = 1 / np.maximum(count_class(data, offsets, LEADING), 1), 1 / np.maximum(words, 1)
    of_class = {name: count_class(data, offsets, table) * per_char for name, table in _RATES.items()}
    found = of_class | {
        "log_words": np.log1p(words),
        "log_lines": np.log1p(lines),
        "mean_word": np.bincount(text, size, n) * per_word,
        "longest_word": np.log1p(longest),
        "short_words": np.bincount(text[size <= 3], minlength=n) * per_word,
        "distinct_words": 1 - repeats(data, text, start, end, hashes, n) * per_word,
        "distinct_pairs": 1 - np.bincount(again, minlength=n) / np.maximum(words - 1, 1),
        "distinct_lines": 1 - repeats(data, line_text, line_start, line_end, span_hashes(data, line_start, line_end), n) / np.maximum(lines, 1),
        "same_as_before": np.bincount(same, minlength=n) * per_word,
        "marked_words": np.bincount(text[_SYMBOL[data[end - 1]] | _EXCLAIM[data[end - 1]]], minlength=n) * per_word,
    }
    return np.stack([found[name] for name in STATISTICS], axis=1).astype(np.float64)


_RATES = {"capitals": CAPITAL, "symbols": _SYMBOL, "exclaims": _EXCLAIM, "marks": _MARK, "stops": _STOP, "digits": _DIGIT, "foreign": _FOREIGN, "blanks": BLANK}


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, whether it must exceed the cut, cut)."""

    terms: tuple[tuple[str, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(and_, ((x[:, STATISTICS.index(s)] > cut) == above for s, above, cut in self.terms))

    def column(self) -> Column:
        return reduce(and_, (F.col(s) > F.lit(cut) if above else F.col(s) <= F.lit(cut) for s, above, cut in self.terms))


def rules_of(trees: Trees) -> list[Rule]:
    """The path to every node but the root, each once; of several cuts of one statistic the tightest stays."""
    out: dict[Rule, None] = {}
    for feature, cut, _ in trees.trees:
        paths: dict[int, dict[tuple[str, bool], float]] = {0: {}}
        for node in range(len(feature)):
            if node not in paths or feature[node] < 0:
                continue
            name = STATISTICS[feature[node]]
            for above, child in ((False, 2 * node + 1), (True, 2 * node + 2)):
                path = dict(paths[node])
                at = path.get((name, above))
                path[name, above] = float(cut[node]) if at is None else (max if above else min)(at, float(cut[node]))
                paths[child] = path
                out[Rule(tuple(sorted((s, a, c) for (s, a), c in path.items())))] = None
    return list(out)


def lasso(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, start: np.ndarray | None = None) -> np.ndarray:
    """Logistic weights (intercept last, not penalised) by accelerated proximal steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    total = w.sum()
    v = np.random.Generator(np.random.PCG64(1)).standard_normal(x.shape[1])
    for _ in range(20):  # the greatest curvature, by power iteration
        v = x.T @ (w * (x @ (v / np.linalg.norm(v))))
    step = total / (0.25 * np.linalg.norm(v) * 1.05)
    at = np.zeros(x.shape[1]) if start is None else start
    ahead, momentum = at, 1.0
    for _ in range(STEPS):
        slope = x.T @ (w * (1 / (1 + np.exp(-np.clip(x @ ahead, -40, 40))) - y)) / total
        new = ahead - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, at, momentum = new + (momentum - 1) / after * (new - at), new, after
    return at


class Ensemble:
    """Weighted rules and statistics, and the share of good rows."""

    def __init__(self, share: float, intercept: float = 0.0, rules: list[tuple[Rule, float]] | None = None, linear: list[tuple[str, float, float, float]] | None = None):
        self.share, self.intercept, self.rules, self.linear = share, intercept, rules, linear or []

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, fold: np.ndarray, share: float) -> Ensemble:
        if not len(y) or y.min() == y.max():
            return cls(share)
        w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        low, high = np.quantile(x, [0.025, 0.975], axis=0)
        spread = np.clip(x, low, high).std(0)
        used = np.flatnonzero(spread > 1e-9)
        rules, columns, seen = [], [], set()
        for rule in rules_of(Trees.fit(x, y, w)):
            holds = rule.holds(x)
            key = np.packbits(holds if holds[0] else ~holds).tobytes()  # a rule and its opposite say the same
            if SUPPORT <= holds.mean() <= 1 - SUPPORT and key not in seen:
                seen.add(key)
                rules.append(rule)
                columns.append(holds / holds.std())
        # A statistic has at most the pull of a typical rule, without its outliers.
        columns += [0.4 * np.clip(x[:, j], low[j], high[j]) / spread[j] for j in used]
        if not columns:
            return cls(share)
        table = np.stack(columns, axis=1)
        middle = table.mean(0)
        p = (w * y).sum() / w.sum()
        most = np.abs((table - middle).T @ (w * (y - p))).max() / w.sum()
        losses = np.zeros(len(PENALTIES))
        for k in range(FOLDS):
            rest = fold != k
            if rest.all() or not rest.any() or y[rest].min() == y[rest].max():
                continue
            at = None
            for i, part in enumerate(PENALTIES):
                at = lasso(table[rest] - middle, y[rest], w[rest], part * most, at)
                raw = (table[~rest] - middle) @ at[:-1] + at[-1]
                losses[i] += (w[~rest] * np.logaddexp(0, np.where(y[~rest] == 1, -raw, raw))).sum()
        at = None
        for part in PENALTIES[: int(np.argmin(losses)) + 1]:
            at = lasso(table - middle, y, w, part * most, at)
        weights = at[:-1]
        kept = [(r, float(weights[i] / r.holds(x).std())) for i, r in enumerate(rules) if weights[i]]
        lines = [(STATISTICS[j], float(0.4 * weights[len(rules) + i] / spread[j]), float(low[j]), float(high[j])) for i, j in enumerate(used) if weights[len(rules) + i]]
        return cls(share, float(at[-1] - middle @ weights), kept, lines)

    def column(self) -> Column:
        """The score as an expression over STATISTICS."""
        if self.rules is None:
            return F.lit(float(self.share))
        parts = [F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        parts += [F.lit(weight) * F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)) for name, weight, low, high in self.linear]
        return 1 / (1 + F.exp(-reduce(add, parts, F.lit(self.intercept))))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The same score of rows in memory."""
        if self.rules is None:
            return np.full(len(x), float(self.share))
        raw = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            raw = raw + np.where(rule.holds(x), weight, 0.0)
        for name, weight, low, high in self.linear:
            raw = raw + weight * np.clip(x[:, STATISTICS.index(name)], low, high)
        return 1 / (1 + np.exp(-raw))


def _described(kept: list[str]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            found = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], [*kept, *STATISTICS])

    return run


_SCHEMA = ", ".join(f"{s} double" for s in STATISTICS)


def fit(docs: DataFrame, labels: DataFrame) -> Ensemble:
    """Rules learned from the texts of ``docs`` that ``labels`` (doc_id, quality) marks."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") > 0).cast("int")).alias("good"))
    known = materialize(known, "quality-labels", narrow=True)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("good = 1").orderBy(*order).limit(SAMPLE).unionByName(known.filter("good = 0").orderBy(*order).limit(SAMPLE))
    # At most 2 * SAMPLE ids, so the broadcast is bounded. Of rows that repeat an id the smallest text is learned from.
    texts = text_rows(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    rows = texts.mapInArrow(_described(["doc_id", "good"]), f"doc_id long, good int, {_SCHEMA}").orderBy("doc_id").toArrow()
    x = np.stack([np.asarray(rows[s]) for s in STATISTICS], axis=1) if rows.num_rows else np.zeros((0, len(STATISTICS)))
    # Rows of equal statistics are copies or nearly so; they stay in one fold.
    fold = (mix64(np.round(x.sum(1) * 1000).astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    return Ensemble.fit(x, np.asarray(rows["good"]).astype(np.int64), fold, ones / n if n else 0.0)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted of every row; all of ``labels`` may be learned from."""
    ensemble = fit(docs, labels)
    described = text_rows(docs).mapInArrow(_described(["doc_id"]), f"doc_id long, {_SCHEMA}")
    return described.select("doc_id", ensemble.column().alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of rows with crc32(doc_id) mod ``folds`` = ``fold`` are not learned."""
    held_out = F.coalesce(crc32_mod("doc_id", folds) == fold, F.lit(False))
    return score_documents(docs, labels.filter(~held_out)).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")
