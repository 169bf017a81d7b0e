"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

One pass over the texts makes a dense feature row for each: densities of a learned
lexicon (words and word beginnings that toxic labelled texts use far more often than
others), how near its words come to the second person, capitals, punctuation,
repetition and obfuscation. Trees are boosted on a bounded sample of labelled rows;
isotonic regression over out-of-fold scores makes probabilities of them, weighted back
to the share of toxic rows among all learnable labels.

Sample bounds: ``SAMPLE`` labelled rows of each label at most (those of the smallest hashes of
doc_id); the lexicon, the trees and the calibration are all learned from these rows, and the
lexicon has ``LEXICON`` learned entries at most, taken from one text of each group of near copies
(the smallest). The share of toxic labels is counted over all labels, and every row is scored.

A score is 0.98 of the calibrated probability and 0.02 of the uncalibrated one, which keeps the
trees' order among the texts of one calibrated step.

Defined results: null and empty texts are scored like others, from features of an empty
text; whole texts are read, however long; without labels of both kinds every score is the
share of toxic labels (0 without any); of several labels of one document a toxic one counts;
null labels and null doc_ids are not learned from, but rows with a null doc_id are scored;
repeated rows get equal scores, and rows that repeat a doc_id are scored by their own texts
(the smallest text is learned from); scores do not depend on how rows are partitioned; an empty table gives no rows; columns other than doc_id
and text may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import crc32_mod, materialize, mix64, opened_rows, packed_rows, sub_batches, text_rows, utf8_buffers
from .shingles import shingle_sets

#: Labelled rows of each label that are learned from, at most.
SAMPLE = 3000
#: Lexicon entries at most, least documents (and share) of toxic texts that use one, least log odds.
LEXICON, SUPPORT, SUPPORT_SHARE, LOG_ODDS = 400, 4, 0.004, 1.5
#: Lengths of word beginnings that may enter the lexicon.
PREFIXES = range(4, 9)
#: Words between a lexicon word and a pronoun that count as near.
NEAR = 5
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, LEAF, RIDGE = 80, 3, 0.15, 48, 4.0, 1.0
FOLDS = 4

#: Second-person forms of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer eure sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os vuestro su".split()
)
#: Common insults, known without any label; learned entries take precedence.
SEED_LEXICON = frozenset(
    "idiot stupid moron loser scum trash pathetic worthless disgusting clown dumb fool ugly hate shut jerk garbage "
    "dumm trottel abschaum versager ekelhaft wertlos erbärmlich hässlich "
    "stupide imbécile crétin ordure minable dégoûtant "
    "estúpido imbécil basura asqueroso patético inútil".split()
)
SEED_ODDS = 2.0
#: Signs and digits that stand for letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

WORD = re.compile(r"\w(?:[\w@$!|*'-]*\w)?")
BARE = re.compile(r"[^\w]|_")
FEATURES = [
    "log_words", "density", "log_hits", "strongest", "mean_weight", "weight_per_word", "distinct_hits", "near_second_person", "second_person",
    "obfuscated", "hidden_hits", "capitals", "shouted", "punctuation", "exclaim", "digits", "other_bytes", "mean_length", "repeated",
]
_CAPITAL, _PUNCT, _EXCLAIM, _DIGIT, _HIGH = (np.zeros(256, bool) for _ in range(5))
_CAPITAL[ord("A") : ord("Z") + 1] = True
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_EXCLAIM[list(b"!?")] = True
_DIGIT[ord("0") : ord("9") + 1] = True
_HIGH[128:] = True


def terms_of(text: str) -> set[str]:
    """Lower-case words and their beginnings."""
    words = {w.lower() for w in WORD.findall(text)}
    return words | {w[:n] for w in words for n in PREFIXES if len(w) > n}


class _Weights(dict):
    """Weight of a word: the greatest of the lexicon's entries that it is or begins with; kept per worker."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[float, bool, bool]:
        """(weight, whether it is hidden by look-alikes, whether it looks obfuscated)."""
        low = word.lower()
        weight = max([self.lexicon.get(low, 0.0), *(self.lexicon.get(low[:n], 0.0) for n in PREFIXES if len(low) > n)])
        odd = not low.isalpha() and any(c.isalpha() for c in low)
        hidden = False
        if odd and not weight:
            bare = BARE.sub("", low.translate(LOOKALIKES))
            weight = max([self.lexicon.get(bare, 0.0), *(self.lexicon.get(bare[:n], 0.0) for n in PREFIXES if len(bare) > n)])
            hidden = weight > 0
        if len(self) > 100_000:
            self.clear()
        self[word] = found = (weight, hidden, odd)
        return found


def features(column: pa.Array, weights: _Weights) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, offsets = utf8_buffers(column)
    sizes = np.maximum(np.diff(offsets), 1).astype(np.float64)

    def rate(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / sizes

    out = np.zeros((len(column), len(FEATURES)), np.float32)
    for name, table in (("capitals", _CAPITAL), ("punctuation", _PUNCT), ("exclaim", _EXCLAIM), ("digits", _DIGIT), ("other_bytes", _HIGH)):
        out[:, FEATURES.index(name)] = rate(table)
    for i, text in enumerate(column.to_pylist()):
        words = WORD.findall(text or "")
        n = max(len(words), 1)
        found = [weights[w] for w in words]
        hits = [k for k, f in enumerate(found) if f[0] > 0]
        you = [k for k, w in enumerate(words) if w in SECOND_PERSON] if hits else []
        near = 0
        if you:
            gap = np.searchsorted(you, hits)
            places = np.array([-(10**9), *you, 10**9])
            near = int((np.minimum(np.array(hits) - places[gap], places[gap + 1] - np.array(hits)) <= NEAR).sum())
        total = sum(found[k][0] for k in hits)
        row = out[i]
        row[0] = np.log1p(len(words))
        row[1] = len(hits) / n
        row[2] = np.log1p(len(hits))
        row[3] = max((found[k][0] for k in hits), default=0.0)
        row[4] = total / max(len(hits), 1)
        row[5] = total / n
        row[6] = np.log1p(len({words[k] for k in hits}))
        row[7] = near / n
        row[8] = len(you) / n
        row[9] = sum(f[2] for f in found) / n
        row[10] = sum(f[1] for f in found) / n
        row[12] = sum(w.isupper() and len(w) > 2 for w in words) / n
        row[17] = sum(map(len, words)) / n
        row[18] = 1 - len(set(words)) / n
    return out


class Trees:
    """Boosted regression trees on quantile bins, logistic loss, second-order leaves."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], base: float):
        self.trees, self.base = trees, base

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # Many features are zero for most rows, so zero gets a cut of its own.
        cuts = [np.unique(np.append(c, 0.0)) for c in cuts]
        binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], axis=1)
        share = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
        base = float(np.log(share / (1 - share)))
        score, trees = np.full(len(y), base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = w * (p - y), w * p * (1 - p)
            feature, cut, value = np.full(2**DEPTH - 1, -1), np.zeros(2**DEPTH - 1), np.zeros(2 ** (DEPTH + 1) - 1)
            node = np.zeros(len(y), np.int64)
            for k in range(2**DEPTH - 1):
                rows = np.flatnonzero(node == k)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                best, found = 1e-6, None
                for j, c in enumerate(cuts):
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                    gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                    gain[(nl < LEAF) | (len(rows) - nl < LEAF)] = 0
                    if len(gain) and gain.max() > best:
                        best, found = gain.max(), (j, int(np.argmax(gain)))
                if found:
                    feature[k], cut[k] = found[0], cuts[found[0]][found[1]]
                    node[rows] = 2 * k + 1 + (x[rows, found[0]] > cut[k])
            for k in np.unique(node):
                rows = node == k
                value[k] = -RATE * g[rows].sum() / (h[rows].sum() + RIDGE)
            score = score + value[node]
            trees.append((feature, cut, value))
        return cls(trees, base)

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = node < len(feature)
                split = np.where(inner, feature[np.minimum(node, len(feature) - 1)], -1)
                go = split >= 0
                right = x[np.arange(len(x)), np.maximum(split, 0)] > cut[np.minimum(node, len(feature) - 1)]
                node = np.where(go, 2 * node + 1 + right, node)
            score += value[node]
        return score


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing weighted fit by pooling adjacent violators: points (score, probability)."""
    levels, at = np.unique(score, return_inverse=True)
    mass, total = np.bincount(at, w), np.bincount(at, w * y)  # equal scores are one point
    pools: list[list[float]] = []  # weight, sum, first and last score
    for s, weight, hits in zip(levels, mass, total):
        pools.append([weight, hits, s, s])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            top = pools.pop()
            pools[-1] = [pools[-1][0] + top[0], pools[-1][1] + top[1], pools[-1][2], top[3]]
    xs = np.array([v for p in pools for v in (p[2], p[3])])
    ys = np.array([v for p in pools for v in (p[1] / p[0],) * 2])
    return xs, ys


class Model:
    def __init__(self, trees: Trees | None, xs: np.ndarray, ys: np.ndarray, share: float):
        self.trees, self.xs, self.ys, self.share = trees, xs, ys, share

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, group: np.ndarray, share: float) -> Model:
        """``group`` keeps near copies in one fold; ``share`` is that of toxic rows among all labels."""
        if not len(y) or y.min() == y.max():
            return cls(None, np.zeros(0), np.zeros(0), share)
        w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        fold = (mix64(group.astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
        out = np.zeros(len(y))
        for k in range(FOLDS):
            rest = fold != k
            if (~rest).any():
                usable = rest if y[rest].size and y[rest].min() < y[rest].max() else np.ones(len(y), bool)
                out[~rest] = Trees.fit(x[usable], y[usable], w[usable]).raw(x[~rest])
        xs, ys = isotonic(out, y.astype(np.float64), w)
        return cls(Trees.fit(x, y, w), xs, ys, share)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        raw = self.trees.raw(x)
        # The steps are calibrated; a little of the raw order is kept within them.
        return np.clip(0.98 * np.interp(raw, self.xs, self.ys) + 0.02 / (1 + np.exp(-raw)), 0, 1)


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log odds of the entries; ``sample`` has text, toxic and shingle group."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            terms = [list(terms_of(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(terms, pa.list_(pa.string()))], ["toxic", "terms"])

    # One text for each group of near copies, the same however the rows are partitioned.
    rows = sample.groupBy("group", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    seed = dict.fromkeys(sorted(SEED_LEXICON), SEED_ODDS)
    if not n1 or not n0:
        return seed
    counts = (
        rows.mapInArrow(split, "toxic int, terms array<string>")
        .select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        .filter(F.col("a") >= max(SUPPORT, SUPPORT_SHARE * n1))
    )
    odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = counts.withColumn("odds", odds).filter(F.col("odds") >= LOG_ODDS).orderBy(sure.desc(), F.col("term")).limit(LEXICON)
    return seed | {r["term"]: float(r["odds"]) for r in best.collect()}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], Model]:
    """(lexicon, model) learned from the texts of ``docs`` that ``labels`` (doc_id, toxic) marks."""
    rows = text_rows(docs)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = materialize(known, "labels", narrow=True)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(SAMPLE).unionByName(known.filter("toxic = 0").orderBy(*order).limit(SAMPLE))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            sets, at = shingle_sets(*utf8_buffers(batch.column("text")))
            # Near copies mostly share their smallest shingle hash.
            group = [int(sets[a].view(np.int64)) if b > a else -1 for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group, pa.int64())], ["doc_id", "text", "toxic", "group"])

    # At most 2 * SAMPLE ids, so the broadcast is bounded. Of rows that repeat an id the smallest text is learned from.
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    sample = materialize(texts.mapInArrow(grouped, "doc_id long, text string, toxic int, group long"), "labelled-sample", narrow=True)
    lexicon = learn_lexicon(sample)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(lexicon)
        for batch in sub_batches(batches, "text"):
            x = features(batch.column("text"), weights)
            columns = [batch.column(c) for c in ("doc_id", "toxic", "group")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(x), pa.list_(pa.float32()))], ["doc_id", "toxic", "group", "feats"])

    at_hand = sample.mapInArrow(described, "doc_id long, toxic int, group long, feats array<float>").orderBy("doc_id").collect()
    x = np.array([r["feats"] for r in at_hand], np.float32).reshape(len(at_hand), len(FEATURES))
    y = np.array([r["toxic"] for r in at_hand], np.int64)
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return lexicon, Model.fit(x, y, np.array([r["group"] for r in at_hand], np.int64), ones / n if n else 0.0)


def _scored(rows: DataFrame, lexicon: dict[str, float], model: Model, text: str, kept: str) -> DataFrame:
    """Column ``kept`` of every row with ``score``; the text is field ``text`` of it if it is a struct."""
    shared = rows.sparkSession.sparkContext.broadcast((lexicon, model))
    state: dict[str, _Weights] = {}
    nested = isinstance(rows.schema[kept].dataType, StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trees = shared.value
        weights = state.setdefault("weights", _Weights(words))
        for batch in batches:
            texts = pc.struct_field(batch.column(kept), text) if nested else batch.column(text)
            whole = pa.RecordBatch.from_arrays([batch.column(kept), texts.cast(pa.string())], [kept, "\0text"])
            for part in sub_batches([whole], "\0text"):
                score = trees.score(features(part.column(1), weights))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], [kept, "score"])

    schema = StructType([StructField(kept, rows.schema[kept].dataType), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted of every row; all of ``labels`` may be learned from."""
    return _scored(text_rows(docs), *fit(docs, labels), "text", "doc_id")


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of rows with crc32(doc_id) mod ``folds`` = ``fold`` are not learned."""
    held_out = F.coalesce(crc32_mod("doc_id", folds) == fold, F.lit(False))
    scored = score_documents(docs, labels.filter(~held_out))
    return scored.withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold.

    Each row is judged by its own text, whatever its doc_id is or which others share it.
    """
    found = _scored(packed_rows(docs), *fit(docs, labels), "text", "row").filter("predicted = 0")
    return opened_rows(found, docs.columns)
